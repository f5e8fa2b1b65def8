"""Ranges of sort keys that depend on the keys alone, for ranks and numbers that no one task can work out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sampled keys for each range.
SAMPLED = 64


def tie(rows: DataFrame) -> Column:
    """A hash of a row's columns, by which rows of equal values are told apart; columns that can't be hashed are left out."""
    columns = [F.col(f"`{f.name}`") for f in rows.schema.fields if not isinstance(f.dataType, T.MapType | T.VariantType)]
    return F.xxhash64(*columns) if columns else F.lit(0).cast("long")


def bounds(rows: DataFrame, key: Column, parts: int | None = None) -> DataFrame:
    """One row: ``bounds``, at most ``parts`` (the number of shuffle partitions) different keys in order, the least of all first.

    They come from a sample of the different keys, ``SAMPLED`` for each range:
    of those whose hashes fall into one cell the one of the lowest hash, so a
    key counts once, however often it stands there, and each task sends at most
    one key a cell.  Reads the rows' keys once, when the result is used.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.select(key.alias("k")).withColumn("h", F.xxhash64("k"))
    cells = keyed.groupBy(F.pmod("h", F.lit(parts * SAMPLED)).alias("cell")).agg(F.min_by("k", "h").alias("k"), F.min("k").alias("least"))
    some = cells.agg(F.array_sort(F.collect_list("k")).alias("some"), F.min("least").alias("least"))
    steps = F.sequence(F.lit(1), F.lit(parts - 1)) if parts > 1 else F.array().cast("array<int>")
    cuts = F.transform(steps, lambda i: F.get("some", F.floor(i * F.size("some") / parts).cast("int")))
    return some.select(F.filter(F.array_sort(F.array_distinct(F.array_append(cuts, F.col("least")))), lambda b: b.isNotNull()).alias("bounds"))


def placed(rows: DataFrame, ends: DataFrame, key: Column, name: str, more: str | None = None) -> DataFrame:
    """Rows with the number of their range, from 0; with ``more``, also whether their key begins it."""
    joined = rows.crossJoin(F.broadcast(ends.withColumnRenamed("bounds", "__bounds")))
    found = joined.withColumn(name, _last_not_above(F.col("__bounds"), key))
    if more:
        found = found.withColumn(more, F.get("__bounds", F.col(name)) == key)
    return found.drop("__bounds")


def _last_not_above(ends: Column, key: Column) -> Column:
    """The place, from 0, of the last of the sorted bounds that isn't above the key, by halving."""

    def halve(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        right, left = F.struct(mid.alias("lo"), s["hi"].alias("hi")), F.struct(s["lo"].alias("lo"), mid.alias("hi"))
        return F.when(s["hi"] - s["lo"] <= 1, s).when(F.get(ends, mid) <= key, right).otherwise(left)

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(ends) + 1)).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(ends).alias("hi")), halve, lambda s: s["lo"])
