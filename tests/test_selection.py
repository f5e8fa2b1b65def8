"""Ranks by rounds of histograms, against sorted lists."""

import datetime as dt
import math
import random
import struct
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.operators import profile, selection


def test_bits_are_those_of_the_double(spark):
    r = random.Random(2)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf"), float("-inf"), 0.1, 1 / 3]
    values += [2.0**k for k in range(-1074, 1024, 13)] + [math.nextafter(2.0**k, s) for k in range(-1020, 1023, 7) for s in (0.0, math.inf)]
    values += [x for x in (struct.unpack("d", struct.pack("Q", r.getrandbits(64)))[0] for _ in range(3000)) if not math.isnan(x)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", selection._ordered_double(F.col("v")).alias("u"))
    got = rows.withColumn("back", selection._double_of(F.col("u"))).collect()
    for row in got:
        bits = struct.unpack("q", struct.pack("d", abs(row["v"])))[0]
        assert row["u"] == (-bits if row["v"] < 0 else bits) and row["back"] == row["v"]
    assert spark.sql("SELECT double('NaN') AS v").select(selection._ordered_double(F.col("v"))).first()[0] > (2047 << 52)


def near(values, q):
    """The element of the nearest rank, halves away from 0."""
    return sorted(values)[math.floor((len(values) - 1) * q + 0.5)]


QS = [0.0, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("few", [0, 40, 10**9])
def test_quantiles_equal_sorted_lists(spark, monkeypatch, few):
    """Spread, repeated, skewed values and a null key, with rounds down to the last bit, some, and one."""
    monkeypatch.setattr(selection, "FEW", few)
    rng = np.random.default_rng(1)
    groups = {"spread": rng.normal(size=400) * 10.0 ** rng.integers(-8, 8, 400), "same": np.full(500, 3.25), "half": np.where(rng.random(300) < 0.5, 7.0, rng.random(300)), None: np.array([-1.5, 2.5]), "one": np.array([4.0])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("spread", None), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {(r["k"], r["q"]): r["value"] for r in profile.nearest_quantiles(df, "v", QS, ["k"]).collect()}
    assert got == {(k, q): near(vs.tolist(), q) for k, vs in groups.items() for q in QS}
    got = {(r["k"], r["q"]): r["value"] for r in profile.quantiles(df, "v", QS, ["k"]).collect()}
    assert set(got) == {(k, q) for k in groups for q in QS}
    assert all(v == pytest.approx(np.quantile(groups[k], q), rel=1e-12) for (k, q), v in got.items())
    everything = np.concatenate(list(groups.values())).tolist()
    assert {r["q"]: r["value"] for r in profile.nearest_quantiles(df, "v", QS).collect()} == {q: near(everything, q) for q in QS}
    assert profile.nearest_quantiles(df.where("v IS NULL"), "v", QS).count() == 0


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("bigint", [-(2**63), 2**63 - 1, 0, -5, 7, 7, 2**40]),
        ("int", [3, -3, 0, 2**31 - 1, -(2**31)]),
        ("decimal(12,2)", [Decimal("-1.25"), Decimal("3.10"), Decimal("0.00"), Decimal("9999999999.99")]),
        ("date", [dt.date(1969, 12, 30), dt.date(2024, 2, 29), dt.date(1970, 1, 1)]),
        ("float", [0.5, -0.25, 3.0, 1e-40]),
    ],
)
def test_values_keep_their_type(spark, monkeypatch, kind, values):
    monkeypatch.setattr(selection, "FEW", 0)
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    got = profile.nearest_quantiles(df, "v", QS)
    assert dict(got.dtypes)["value"] == kind
    assert {r["q"]: r["value"] for r in got.collect()} == {q: near([r["v"] for r in df.collect()], q) for q in QS}
    with pytest.raises(TypeError):
        profile.nearest_quantiles(spark.createDataFrame([("x",)], "v string"), "v", QS)


def test_rows_are_read_once_and_few_values_take_one_round(spark, monkeypatch):
    """Three keys of seven values, each on more rows than a cell may have that is sorted."""
    monkeypatch.setattr(selection, "FEW", 20)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(2100).selectExpr("id % 3 AS k", "id % 7 - 3.5D AS v").mapInArrow(counted, "k long, v double")
    rounds = []
    monkeypatch.setattr(selection, "_in_cells", lambda *a, each=selection._in_cells: rounds.append(a) or each(*a))
    got = {r["k"]: r["value"] for r in profile.quantiles(df, "v", [0.5], ["k"]).collect()}
    assert got == {k: -0.5 for k in range(3)}
    assert read.value == 2100 and len(rounds) == 2
