"""Elements of given rank, exactly, by rounds of histograms over the bits of the value."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyfold.sources import scratch

#: Bits of a value that a round looks at, different values of a cell that are sorted instead of looked at again, and ranks that are broadcast.
BITS, FEW, SMALL = 16, 100_000, 200_000
_ONE = 1 << 52


@F.arrow_udf(T.LongType())
def _ordered_double(values: pa.Array) -> pa.Array:
    """The bits of a double as a number in the same order; NaN is above infinity, both zeros are 0."""
    x = values.to_numpy(zero_copy_only=False).astype(np.float64)
    bits = np.where(np.isnan(x), 2047 * _ONE + 1, np.abs(x).view(np.int64))
    return pa.array(np.where(x < 0, -bits, bits), mask=values.is_null().to_numpy(zero_copy_only=False))


def _double_of(u: Column) -> Column:
    b = F.abs(u)
    e, rest = F.shiftright(b, 52), b.bitwiseAND(F.lit(_ONE - 1)).cast("double")
    a = (
        F.when(b > 2047 * _ONE, float("nan"))
        .when(b == 2047 * _ONE, float("inf"))
        .when(e == 0, rest * F.lit(2.0**-1074))
        .otherwise((1 + rest / float(_ONE)) * F.pow(F.lit(2.0), (e - 1023).cast("double")))
    )
    return F.when(u < 0, -a).otherwise(a)


def _forms(kind: T.DataType) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
    """A type's values as longs in the same order, and back."""
    if isinstance(kind, T.IntegralType):
        return lambda c: c.cast("long"), lambda u: u.cast(kind)
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return lambda c: _ordered_double(c.cast("double")), lambda u: _double_of(u).cast(kind)
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        scale = 10**kind.scale
        return lambda c: (c.cast(T.DecimalType(38, kind.scale)) * F.lit(scale)).cast("long"), lambda u: (u.cast(T.DecimalType(38, 0)) / F.lit(scale)).cast(kind)
    if isinstance(kind, T.DateType):
        return lambda c: F.unix_date(c).cast("long"), lambda u: F.date_from_unix_date(u.cast("int"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros, F.timestamp_micros
    raise TypeError(f"no ranks of {kind.simpleString()}")


def _in_cells(data: DataFrame, named: list[str], cell: Column, ranks: Callable[[Column], Column], asked: DataFrame | None, settled: int) -> DataFrame:
    """(named, cell, values, q, rank): the cells that hold the ranks, how many different values they have, and the ranks within.

    ``data`` has ``w`` rows of each value.  With ``asked`` (see ``at_ranks``), only values whose bits from ``settled`` on are those of a cell asked for are counted.
    """
    if asked is None:
        cells = data.groupBy(*named, cell.alias("cell")).agg(F.sum("w").alias("n"), F.count("*").alias("values"))
        asks, within = ranks(F.sum("n").over(Window.partitionBy(*(named or [F.lit(0)])))), list(named)
    else:
        same = [F.col(n).eqNullSafe(F.col(f"a{n}")) for n in named] + [F.col("prefix") == F.col("a_prefix")]
        met = data.withColumn("prefix", F.shiftright("u", settled)).join(asked, same)
        cells = met.groupBy(*named, "prefix", cell.alias("cell")).agg(F.sum("w").alias("n"), F.count("*").alias("values"), F.any_value("asks").alias("asks"))
        asks, within = F.col("asks"), [*named, "prefix"]
    ahead = F.sum("n").over(Window.partitionBy(*(within or [F.lit(0)])).orderBy("cell")) - F.col("n")
    placed = cells.select(*named, "cell", "n", "values", ahead.alias("ahead"), asks.alias("asks"))
    each = placed.select(*named, "cell", "n", "values", "ahead", F.explode("asks").alias("ask")).where("ask.rank >= ahead AND ask.rank < ahead + n")
    return each.select(*named, "cell", "values", "ask.q", (F.col("ask.rank") - F.col("ahead")).alias("rank"))


def at_ranks(rows: DataFrame, value: str, keys: list[str], ranks: Callable[[Column], Column]) -> DataFrame:
    """(keys, q, value): elements of the values of each key, for ``ranks(n)``, an array of (q, rank), of their number n.

    The rows are read once, to count the different values of each key; the
    counts are written to the shared folder, each with its value as a number in
    the same order.  A round adds up the counts by the highest bits that aren't
    settled yet, and follows each rank into the cell that holds it, for all keys
    and ranks at once.  So a task sends one count for each value or cell that it
    has, and no task needs the values of a key, however they are spread or
    repeated.  When no cell that is asked for holds more than ``FEW`` different
    values, those are sorted.  Ranks go to the tasks by broadcast as long as
    there are at most ``SMALL``.

    Reads the counts twice, or up to four times while cells stay large, and runs
    all rounds but the last as it is called.  Nulls aren't counted.  NaN is
    above all others.
    """
    there, back = _forms(rows.schema[value].dataType)
    named = [f"__k{i}" for i in range(len(keys))]
    # equal values are one row with their number, so that rounds over a column of few values are short
    data = rows.where(F.col(value).isNotNull()).groupBy(*[F.col(k).alias(n) for k, n in zip(keys, named, strict=True)], F.col(value).alias("__v")).agg(F.count("*").alias("w"))
    data = data.select(*named, there(F.col("__v")).alias("u"), "w")
    folder, asked, settled, few = scratch.folder(rows.sparkSession, "ranks"), None, 64, False
    data.write.parquet(f"{folder}/values")
    data = rows.sparkSession.read.schema(data.schema).parquet(f"{folder}/values")
    while not few and settled > BITS:
        shift = settled - BITS
        found = _in_cells(data, named, F.shiftright("u", shift), ranks, asked, settled)
        held = found.groupBy(*[F.col(n).alias(f"a{n}") for n in named], F.col("cell").alias("a_prefix")).agg(F.max("values").alias("values"), F.collect_list(F.struct("q", "rank")).alias("asks"))
        held.write.parquet(f"{folder}/{shift}")
        asked, settled = rows.sparkSession.read.parquet(f"{folder}/{shift}"), shift
        most, cells = asked.agg(F.max("values"), F.count("*")).first()
        few = (most or 0) <= FEW
        asked = F.broadcast(asked.drop("values")) if cells <= SMALL else asked.drop("values")
    found = _in_cells(data, named, F.col("u"), ranks, asked, settled)
    return found.select(*[F.col(n).alias(c) for n, c in zip(named, keys, strict=True)], "q", back(F.col("cell")).alias("value"))
