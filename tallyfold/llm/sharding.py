"""Shards of equal row counts that keep equal texts together, by balanced label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.llm.store import Store

SHARDS = 24
#: Rounds in which linked documents may move, and the part of a shard's rows by which flows between two shards may differ.
ROUNDS, SLACK = 3, 0.02
#: Parts of each shard's groups, and of a large group, that are ranked by themselves, at least, and the rows of a shard for
#: each of which there is one.
PARTS, PART_ROWS = 64, 100_000


def propagate(counts: DataFrame, store: Store, shards: int = SHARDS, rounds: int = ROUNDS, slack: float = SLACK) -> DataFrame:
    """(g, label, members) of each group, from ``counts(g, shard, c)``: documents of a group in a shard.

    Documents are linked with all others of their group, so those of one group
    in one shard have the same neighbours and are counted, not listed.  In each
    round the shard that holds most of a group draws the rest.  Of what wants to
    go from shard s to t, as much goes as wants to come back, and ``slack`` of a
    shard's rows more; groups are let through by hash.
    """
    state = store.put(counts, "state-0")
    for k in range(rounds):
        of = Window.partitionBy("g")
        best = F.max(F.struct("c", F.xxhash64("g", "shard").alias("h"), "shard")).over(of)["shard"]
        drawn = state.withColumn("to", best)
        # shards^2 rows at most
        flows = drawn.where("shard <> to").groupBy("shard", "to").agg(F.sum("c").alias("wants"))
        back = flows.select(F.col("shard").alias("to"), F.col("to").alias("shard"), F.col("wants").alias("returns"))
        room = state.agg((F.sum("c") * slack / shards / shards + 1).alias("spare"))
        share = flows.join(back, ["shard", "to"], "left").crossJoin(F.broadcast(room)).select(
            "shard", "to", ((F.coalesce("returns", F.lit(0)) + F.col("spare")) / F.col("wants")).alias("share")
        )
        # a uniform number of [0, 1) for each group, shard and round
        chance = F.shiftrightunsigned(F.xxhash64("g", "shard", F.lit(k)), 11) / float(1 << 53)
        moved = drawn.join(F.broadcast(share), ["shard", "to"], "left").select(
            "g", F.when((F.col("shard") != F.col("to")) & (chance < F.col("share")), F.col("to")).otherwise(F.col("shard")).alias("shard"), "c"
        )
        state = store.put(moved.groupBy("g", "shard").agg(F.sum("c").alias("c")), f"state-{k + 1}")
    return state.groupBy("g").agg(F.max(F.struct("c", F.xxhash64("g", "shard").alias("h"), "shard"))["shard"].alias("label"), F.sum("c").alias("members"))


def assign(docs: DataFrame, store: Store | None = None, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row for each row of ``docs``: id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``rows``: shards differ by one row at most.  Labels of the
    propagation put all rows in one order, in which every group lies together,
    between single rows of its label; the order is cut into ``shards`` equal
    runs.  At most shards - 1 cuts meet a group, besides those that a group
    larger than a shard needs.  ``slot`` counts a shard's rows from 0.

    Size is the UTF-8 bytes of the text and 8; a null text has no bytes, and
    null texts are a group.  Rows without an id and repeated rows are rows like
    others.  ``grown_shard`` belongs to another law and is null.  An empty table
    gives an empty result.
    """
    store = store or Store(docs.sparkSession, "sharding")
    text = F.col(text_col).cast("string")
    base = store.put(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
            F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.md5(text.cast("binary")), F.lit("")).alias("g"),
        ).withColumn("shard", F.pmod(F.xxhash64("id", F.lit(8)), F.lit(shards).cast("long")).cast("int")),
        "rows",
    )
    total = base.count()
    if not total:
        return base.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    groups = base.groupBy("g").agg(F.count("*").alias("members")).where("members > 1")
    counts = base.groupBy("g", "shard").agg(F.count("*").alias("c")).join(groups.select("g"), "g", "left_semi")
    labels = store.put(propagate(counts, store, shards), "labels")

    parts = max(PARTS, -(-total // (shards * PART_ROWS)))
    large = max(64, total // (shards * parts))
    own = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(parts).cast("long")).cast("int")
    of_group = F.pmod(F.xxhash64("g"), F.lit(parts).cast("long")).cast("int")
    linked = F.col("label").isNotNull()
    big = F.coalesce(F.col("members") > large, F.lit(False))
    key = ["label", "zone", "p", "whole", "q"]
    keyed = base.join(labels, "g", "left").select(
        "id",
        "size",
        "text_crc32",
        "g",
        F.coalesce("label", "shard").alias("label"),
        # singles on both sides of the groups, so that a cut that drifts still falls among singles
        F.when(linked, 1).otherwise(F.when(F.xxhash64("id", F.lit(10)) >= 0, 0).otherwise(2)).alias("zone"),
        F.when(big, parts).when(linked, of_group).otherwise(own).alias("p"),
        F.when(big, F.col("g")).otherwise(F.lit("")).alias("whole"),
        F.when(big, own).otherwise(0).alias("q"),
    )
    keyed = store.put(keyed, "keyed")
    # one row for each part: 3 * shards * parts of small groups and singles, parts for each of at most shards * parts large groups
    ahead = keyed.groupBy(*key).agg(F.count("*").alias("n")).withColumn("ahead", F.sum("n").over(Window.orderBy(*key)) - F.col("n")).drop("n")
    rank = F.col("ahead") + F.row_number().over(Window.partitionBy(*key).orderBy("g", "id", "size")) - 1
    ranked = keyed.join(store.put(ahead, "parts"), key).withColumn("rank", rank)
    placed = ranked.withColumn("shard", F.expr(f"(rank * {shards}) DIV {total}").cast("int"))
    return placed.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("rank") - F.expr(f"(shard * CAST({total} AS BIGINT) + {shards - 1}) DIV {shards}")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
