"""Leaderboards, ranks, picks and samples.  Every order is total: ties go by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Which way a metric's leaderboard runs: True for the smallest first.
METRICS = {"neg_rate": False, "pos_rate": False, "net_sentiment": True, "polarization": False, "neg_count": False}


def at_least(rows: DataFrame, least: int, count: str = "comment_count") -> DataFrame:
    return rows.where(F.col(count) >= least)


def threshold_sweep(rows: DataFrame, limits: list[int], count: str = "comment_count") -> DataFrame:
    """How many rows reach each of the limits, and how many comments they have."""
    steps = F.explode(F.array(*map(F.lit, limits))).alias("least")
    return rows.select(count, steps).groupBy("least").agg(F.count_if(F.col(count) >= F.col("least")).alias("entities"), F.coalesce(F.sum(F.when(F.col(count) >= F.col("least"), F.col(count))), F.lit(0)).alias("comments"))


def _order(metric: str, ascending: bool | None, name: str) -> list[Column]:
    up = METRICS[metric] if ascending is None else ascending
    return [F.asc(metric) if up else F.desc(metric), F.asc(name)]


def leaderboard(rows: DataFrame, metric: str, top: int, least: int = 0, ascending: bool | None = None, name: str = "entity") -> DataFrame:
    """The first ``top`` of the rows with ``least`` comments, with their rank."""
    best = at_least(rows, least).orderBy(*_order(metric, ascending, name)).limit(top)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*_order(metric, ascending, name))))


def ranked(rows: DataFrame, metric: str, ascending: bool | None = None, name: str = "entity") -> DataFrame:
    """Each row's place among all; for frames of one row an entity."""
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(*_order(metric, ascending, name))))


def rank_of(rows: DataFrame, entity: str, metric: str, ascending: bool | None = None, name: str = "entity") -> int | None:
    """One entity's place, without sorting the others: one more than how many come before it."""
    own = rows.where(F.col(name) == entity).select(F.col(metric).alias("__m"), F.col(name).alias("__n")).limit(1)
    up = METRICS[metric] if ascending is None else ascending
    ahead = (F.col(metric) < F.col("__m")) if up else (F.col(metric) > F.col("__m"))
    tied = (F.col(metric) == F.col("__m")) & (F.col(name) < F.col("__n"))
    found = rows.crossJoin(F.broadcast(own)).agg(F.count("*").alias("n"), F.count_if(ahead | tied).alias("before")).first()
    return None if not found["n"] else found["before"] + 1


def first_of_group(rows: DataFrame, group: str, order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group, with their place in it."""
    w = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def both_ends(rows: DataFrame, group: str, metric: str, name: str, n: int) -> DataFrame:
    """The highest and the lowest ``n`` of each group: side ``hostile`` and side ``friendly``."""
    top = first_of_group(rows, group, [F.desc(metric), F.asc(name)], n).withColumn("side", F.lit("hostile"))
    low = first_of_group(rows, group, [F.asc(metric), F.asc(name)], n).withColumn("side", F.lit("friendly"))
    return top.unionByName(low)


def quadrants(rows: DataFrame, x: str, y: str) -> DataFrame:
    """Where each row lies against the medians of two columns."""
    middle = rows.agg(F.median(x).alias("mx"), F.median(y).alias("my"))
    side = F.concat_ws("_", F.when(F.col(x) >= F.col("mx"), "high").otherwise("low"), F.when(F.col(y) >= F.col("my"), "high").otherwise("low"))
    return rows.crossJoin(F.broadcast(middle)).withColumn("quadrant", side).drop("mx", "my")


def lot(key: str, seed: int) -> Column:
    """A row's lot in a sample: the md5 of the seed and its key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def sampled(rows: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), the same on every run."""
    return rows.orderBy(lot(key, seed), key).limit(n)


def sampled_by(rows: DataFrame, n: int, key: str, stratum: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows of each stratum.

    Each is first thinned to a part of its rows that holds ``n``, by counts of
    lots that begin alike, so no stratum is sorted whole.
    """
    drawn = rows.withColumn("__h", lot(key, seed))
    cell = F.substring("__h", 1, 3)
    cells = drawn.groupBy(stratum, cell.alias("__cell")).agg(F.count("*").alias("__n"))
    ahead = F.sum("__n").over(Window.partitionBy(stratum).orderBy("__cell")) - F.col("__n")
    open_cells = cells.withColumn("__ahead", ahead).where(F.col("__ahead") < n).select(F.col(stratum).alias("__s"), "__cell")
    near = drawn.withColumn("__c", cell).join(open_cells, F.col(stratum).eqNullSafe(F.col("__s")) & (F.col("__c") == F.col("__cell")), "left_semi")
    w = Window.partitionBy(stratum).orderBy("__h", key)
    return near.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= n).drop("__k", "__h", "__c")
