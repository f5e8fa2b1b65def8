"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.store import Store


def components(edges: DataFrame, store: Store, name: str = "cc") -> DataFrame:
    """(v, component) of every vertex of ``edges(a, b)``; component is the smallest reachable vertex.

    Each round hooks every vertex to its smallest neighbour, follows that
    pointer once more, and contracts the edges to what they now point at, so a
    star goes in one round and a path of n vertices in a logarithm of n.  Rounds
    read and write tables in the shared folder; only a row count reaches the
    driver.  An empty edge table gives an empty result.
    """
    edges = store.put(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-e0")
    found, k = None, 0
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = store.put(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("p")).select("v", F.least("v", "p").alias("p")), f"{name}-h{k}")
        up = hook.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        hook = store.put(hook.join(up, "p", "left").select("v", F.coalesce("pp", "p").alias("p")), f"{name}-p{k}")
        if found is None:
            found = hook.select("v", F.col("p").alias("component"))
        else:
            step = hook.select(F.col("v").alias("component"), "p")
            found = store.put(found.join(step, "component", "left").select("v", F.coalesce("p", "component").alias("component")), f"{name}-m{k}")
        a = hook.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        b = hook.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        edges = store.put(
            edges.join(a, "a").join(b, "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(),
            f"{name}-e{k + 1}",
        )
        store.drop(f"{name}-e{k}", f"{name}-h{k}")
        if k:  # what was found is in a table of its own by now
            store.drop(f"{name}-p{k}", f"{name}-p0" if k == 1 else f"{name}-m{k - 1}")
        k += 1
    return edges.select(F.col("a").alias("v"), F.col("b").alias("component")) if found is None else found
