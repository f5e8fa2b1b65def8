"""Descriptions of a table: counts, shares, quantiles, completeness, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.numbers import rate
from tallyfold.operators.selection import at_ranks


def value_counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def shares(counted: DataFrame, count: str = "n", name: str = "pct", digits: int = 2) -> DataFrame:
    """Each row's percentage of all."""
    total = counted.agg(F.sum(count).alias("__total"))
    return counted.crossJoin(F.broadcast(total)).withColumn(name, rate(100 * F.col(count), F.col("__total"), digits)).drop("__total")


def group_stats(rows: DataFrame, key: str, value: str) -> DataFrame:
    found = rows.groupBy(key).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"), F.sum(value).alias("sum")
    )
    middle = quantiles(rows, value, [0.5], [key]).select(F.col(key).alias("__key"), F.col("value").alias("median"))
    joined = found.join(middle, F.col(key).eqNullSafe(F.col("__key")), "left")
    return joined.select(key, "n", "mean", "median", "std", "min", "max", "sum")


def nearest_quantiles(rows: DataFrame, value: str, quantiles: list[float], keys: list[str] | None = None) -> DataFrame:
    """(keys, q, value) with the element nearest to each quantile; see ``selection.at_ranks``."""
    return at_ranks(rows, value, keys or [], lambda n: F.array(*[F.struct(F.lit(q).alias("q"), F.round((n - 1) * q).cast("long").alias("rank")) for q in quantiles]))


def quantiles(rows: DataFrame, value: str, asked: list[float], keys: list[str] | None = None) -> DataFrame:
    """(keys, q, value) with each quantile, between two elements in proportion; see ``selection.at_ranks``."""
    keys = keys or []

    def around(n: Column) -> Column:
        """The elements on both sides of each quantile; q carries what lies between them."""
        both = []
        for q in asked:
            point = (n - 1) * q
            share = point - F.floor(point)
            both += [F.struct(F.struct(F.lit(q).alias("q"), part.alias("part")).alias("q"), place.cast("long").alias("rank")) for part, place in ((1 - share, F.floor(point)), (share, F.floor(point) + 1))]
        # the one above the last element isn't there, and isn't asked for
        return F.filter(F.array(*both), lambda a: a["rank"] < n)

    near = at_ranks(rows, value, keys, around).select(*keys, F.col("q.q").alias("q"), F.col("q.part").alias("part"), F.col("value").cast("double").alias("value"))
    found = near.groupBy(*keys, "q").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.max_by("part", "value").alias("part"), F.count("*").alias("n"))
    return found.select(*keys, "q", F.when((F.col("n") == 1) | (F.col("lo") == F.col("hi")), F.col("lo")).otherwise(F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("value"))


def describe(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row for each numeric column: count, null_count, mean, std, min, quartiles, max; all exact."""
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])).alias("e")).select("e.*")
    basic = long.groupBy("column").agg(
        F.count("x").alias("count"), F.count_if(F.col("x").isNull()).alias("null_count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max")
    )
    # one row for each column
    cuts = quantiles(long, "x", [0.25, 0.5, 0.75], ["column"]).groupBy("column").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value"))
    cuts = cuts.select("column", *[F.col(f"`{q}`").alias(f"p{100 * q:.0f}") for q in (0.25, 0.5, 0.75)])
    return basic.join(cuts, "column", "left").select("column", "count", "null_count", "mean", "std", "min", "p25", "p50", "p75", "max")


def completeness(rows: DataFrame) -> DataFrame:
    """One row for each column: nulls and their percentage, in one pass."""
    counted = rows.agg(F.count("*").alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(f"__{i}") for i, c in enumerate(rows.columns)])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("nulls")) for i, c in enumerate(rows.columns)]))
    return counted.select("__rows", each.alias("x")).select("x.column", "x.nulls", rate(100 * F.col("x.nulls"), F.col("__rows"), 2).alias("pct"))


def exploded_counts(rows: DataFrame, items: str, name: str) -> DataFrame:
    """How often each element comes up; an empty list counts as one null."""
    return rows.select(F.explode_outer(items).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def histogram(rows: DataFrame, value: str, bins: int) -> DataFrame:
    """(bin from 0, lower bound, n) of equal-width bins between the least and the largest value; empty bins included."""
    ends = rows.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi")).where("lo IS NOT NULL")
    x = F.col(value).cast("double")
    cell = F.least(F.lit(bins - 1), F.floor(F.coalesce(F.try_divide((x - F.col("lo")) * bins, F.col("hi") - F.col("lo")), F.lit(0.0)))).cast("int")
    counted = rows.where(F.col(value).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(cell.alias("bin")).agg(F.count("*").alias("n"))
    grid = ends.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    return grid.join(counted, "bin", "left").select("bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("lower"), F.coalesce("n", F.lit(0)).alias("n"))


def month_pivot(rows: DataFrame, month: Column, kind: str, values: list[str]) -> DataFrame:
    """Counts by month, one column for each of ``values``."""
    return rows.groupBy(month.alias("month")).pivot(kind, values).agg(F.count(F.lit(1))).fillna(0, values)
