import math

import numpy as np
import pytest

from tallyfold.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x int, component string, id int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1, "c", 2) for i, v in rows], schema)


def brute(x):
    """Exact covariance by integers, eigenvectors in double precision."""
    n, d = x.shape
    sums = [int(s) for s in x.sum(0)]
    far = [[n * int(v) - s for v, s in zip(row, sums, strict=True)] for row in x]
    cov = np.array([[sum(r[i] * r[j] for r in far) / n**3 for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(cov)
    return [sum(v * v for v in r) for r in far], values[::-1], vectors[:, ::-1], np.array(far, float) / n


@pytest.fixture
def some():
    rng = np.random.default_rng(4)
    return (rng.normal(size=(120, 12)) @ rng.normal(size=(12, 12)) * 0.3).astype(np.float32)


def test_equal_to_brute_force(spark, some):
    odd = [(900, None), (901, []), (902, [float("nan")] + [1.0] * 11), (903, [None] + [1.0] * 11), (904, [float("-inf")] + [0.0] * 11), (905, [1.0] * 5)]
    rows = [(k, v.tolist()) for k, v in enumerate(some)] + [(None, some[3].tolist()), (5, some[5].tolist()), (5, some[9].tolist())]
    got = whitening.whitened(frame(spark, rows + odd))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    x = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64) + 100_000
    deviation, values, vectors, centred = brute(x)
    want = centred @ vectors[:, :8] / np.sqrt(values[:8])
    found = got.collect()
    assert len(found) == 8 * len(rows)
    assert sorted((r["vec_id"], r["component"], r["deviation"]) for r in found if r["vec_id"] is not None) == sorted((i, k + 1, d) for (i, _), d in zip(rows, deviation, strict=True) for k in range(8) if i is not None)
    by = {(r["vec_id"], r["component"]): r for r in found if r["vec_id"] not in (None, 5)}
    for k in range(8):
        mine = np.array([by[i, k + 1]["whitened"] for i in range(120) if i != 5])
        theirs = np.array([want[i, k] for i in range(120) if i != 5])
        assert min(abs(mine - theirs).max(), abs(mine + theirs).max()) < 1e-9
    assert all(r["n"] == len(rows) and r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9) for r in found)
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9


def test_pairs_in_several_aggregations_give_the_same(spark, some):
    rows = whitening.fit_list(frame(spark, [(k, v.tolist()) for k, v in enumerate(some)]))
    a, b = whitening.fit(rows), whitening.fit(rows, at_once=7)
    assert np.allclose(a.matrix, b.matrix, atol=1e-12) and a.n == b.n == 120


def test_few_dimensions_and_no_variance(spark):
    two = whitening.whitened(frame(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [0.5, 1.0])])).collect()
    assert {r["component"] for r in two} == {1, 2}
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in two)
    assert all(r["explained"] == (1.0 if r["component"] == 1 else 0.0) and r["identity_error"] < 1e-9 for r in two)
    one = whitening.whitened(frame(spark, [(1, [0.25, 1.0])])).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    assert whitening.whitened(frame(spark, [])).count() == 0
    assert whitening.whitened(frame(spark, [(1, None), (2, [])])).count() == 0


def test_huge_entries_have_a_place(spark):
    got = whitening.whitened(frame(spark, [(1, [1e38, 0.0]), (2, [-1e38, 1.0]), (3, [0.0, 0.5])])).collect()
    assert len(got) == 6 and all(r["deviation"] is None or r["vec_id"] == 3 for r in got)
    assert all(math.isfinite(r["whitened"]) for r in got if r["component"] == 1)


def test_doubles_are_floored_exactly(spark):
    values = [0.1, -0.1, 1 / 1024, -1 / 1024, 0.0009765624, -0.0]
    rows = spark.createDataFrame([(1, values)], "vec_id long, embedding array<double>")
    assert whitening.fit_list(rows).first()["x"] == [math.floor(1024 * v) + 100_000 for v in values]
