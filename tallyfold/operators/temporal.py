"""Weekly and cumulative series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.functions.numbers import rate, round_half_away


def complete_weeks(weekly: DataFrame) -> DataFrame:
    """Without the last week, which may be a stub."""
    last = weekly.agg(F.max("week").alias("last_week"))
    return weekly.crossJoin(F.broadcast(last)).where(F.col("week") != F.col("last_week")).drop("last_week")


def cumulative_metrics(weekly: DataFrame, drop_last_week: bool = True) -> DataFrame:
    """``weekly(entity, week, neg_count, comment_count)`` as running sums on the full grid of entities and weeks."""
    rows = weekly.withColumn("week", F.to_date("week"))
    rows = complete_weeks(rows) if drop_last_week else rows
    grid = rows.select("entity").distinct().crossJoin(F.broadcast(rows.select("week").distinct()))
    filled = grid.join(rows.select("entity", "week", "neg_count", "comment_count"), ["entity", "week"], "left").fillna(0, ["neg_count", "comment_count"])
    run = Window.partitionBy("entity").orderBy("week").rowsBetween(Window.unboundedPreceding, 0)
    summed = filled.select("entity", "week", F.sum("neg_count").over(run).alias("cum_neg"), F.sum("comment_count").over(run).alias("cum_total"))
    return summed.withColumn("cum_neg_rate", rate(F.col("cum_neg"), F.col("cum_total")))


def mask_below(cumulative: DataFrame, least: int) -> DataFrame:
    """The rate is null in weeks before an entity has ``least`` comments; rows stay."""
    return cumulative.withColumn("cum_neg_rate", F.when(F.col("cum_total") >= least, F.col("cum_neg_rate")))


def leaders(cumulative: DataFrame, top: int, least: int) -> DataFrame:
    """The entities of the highest rate in the last week, of those with ``least`` comments by then."""
    last = cumulative.agg(F.max("week").alias("last_week"))
    final = cumulative.crossJoin(F.broadcast(last)).where((F.col("week") == F.col("last_week")) & (F.col("cum_total") >= least))
    return final.orderBy(F.desc("cum_neg_rate"), "entity").limit(top).select("entity")


def race_long(cumulative: DataFrame, top: int = 15, min_ranking: int = 5000, min_entry: int = 1000) -> DataFrame:
    chosen = leaders(cumulative, top, min_ranking)
    return mask_below(cumulative.join(F.broadcast(chosen), "entity", "left_semi"), min_entry)


def race_wide(cumulative: DataFrame, dim: DataFrame, weeks: list[str], top: int = 15, min_ranking: int = 5000, min_entry: int = 1000) -> DataFrame:
    """Label, Category, Image and a percentage for each of ``weeks`` (ISO dates): the leaders, one row each.

    ``dim(entity, team, image)`` gives what is missing as an empty text.
    """
    long = race_long(cumulative, top, min_ranking, min_entry).withColumn("week", F.col("week").cast("string"))
    wide = long.groupBy("entity").pivot("week", weeks).agg(F.first(round_half_away(F.col("cum_neg_rate") * 100, 2)))
    return wide.join(F.broadcast(dim), "entity", "left").select(
        F.col("entity").alias("Label"), F.coalesce("team", F.lit("")).alias("Category"), F.coalesce("image", F.lit("")).alias("Image"), *[F.col(f"`{w}`") for w in weeks]
    )


def checkpoint_rank(cumulative: DataFrame, weeks: list[str]) -> DataFrame:
    """Rank by rate among the entities in each of the weeks."""
    w = Window.partitionBy("week").orderBy(F.col("cum_neg_rate").desc_nulls_last(), "entity")
    return cumulative.where(F.col("week").cast("string").isin(weeks)).select("week", "entity", "cum_neg_rate", F.row_number().over(w).alias("rank"))


def weekly_rollup(weekly: DataFrame) -> DataFrame:
    """All entities together by week."""
    summed = weekly.groupBy("week").agg(
        F.sum("comment_count").alias("comment_count"), F.sum("neg_count").alias("neg_count"), F.sum("pos_count").alias("pos_count"), F.countDistinct("entity").alias("entities")
    )
    return summed.withColumn("neg_rate", rate(F.col("neg_count"), F.col("comment_count")))


def low_weeks(rollup: DataFrame, share: float = 0.25) -> DataFrame:
    """Weeks with less than ``share`` of the median week's comments."""
    middle = rollup.agg(F.median("comment_count").alias("median_count"))
    return rollup.crossJoin(F.broadcast(middle)).select("week", "comment_count", "median_count", (F.col("comment_count") < share * F.col("median_count")).alias("low"))


def rolling_mean(series: DataFrame, order: str, value: str, rows: int = 7, by: list[str] | None = None) -> DataFrame:
    """Mean of the last ``rows`` rows, null until there are as many.  Meant for one row a day, not for raw rows."""
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(order).rowsBetween(1 - rows, 0)
    return series.withColumn("rolling", F.when(F.count(value).over(w) == rows, F.avg(value).over(w)))


def date_gaps(days: DataFrame, column: str) -> DataFrame:
    """Days between the first and the last that have no row."""
    seen = days.select(F.col(column).alias("day")).where("day IS NOT NULL").distinct()
    span = seen.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).where("lo IS NOT NULL")
    return span.select(F.explode(F.sequence("lo", "hi")).alias("day")).join(seen, "day", "left_anti")


def running(rows: DataFrame, key: str, order: list[str | Column], value: str, name: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.sum(value).over(w))
