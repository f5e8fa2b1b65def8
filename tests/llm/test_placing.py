import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from tallyfold.llm import mixing, sharding


def fill(sizes, weights, most=3):
    """Targets by resharing the excess until none is left."""
    full, target = set(), {}
    total = sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        w = sum(weights[s] for s in sizes if s not in full)
        target = {s: most * sizes[s] if s in full else left * weights[s] / w for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def test_targets_and_taken(spark, table, make):
    docs, k = [], 0
    for source, n, length in (("a", 3, 10), ("b", 40, 30), ("c", 20, 50), (None, 5, 12), ("é", 1, 1)):
        for _ in range(n):
            docs.append((k, make(k, length), source))
            k += 1
    docs += [(None, "x y z", "b"), (900, None, "c"), (901, "", "a"), (1, make(1, 10), "a")]
    got = mixing.curriculum(table(docs)).collect()
    assert len(got) == len(docs)
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len((t or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = fill(dict(sizes), {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    longest = max(len((t or "").split()) for _, t, _ in docs)
    assert all(abs(taken[s] - want[s]) <= longest for s in sizes)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.curriculum(table(docs)).collect()), key=str)
    assert mixing.curriculum(table([])).count() == 0


def test_arranged_repeats_rows_in_schedule(spark, table, make):
    docs = table([(k, make(k, 20), f"s{k % 3}") for k in range(60)])
    want = {r["doc_id"]: r["copies"] for r in mixing.curriculum(docs).collect()}
    rows = mixing.arranged(docs).collect()
    assert Counter(r["doc_id"] for r in rows) == {k: n for k, n in want.items() if n}
    # s0 comes early, s2 late
    place = defaultdict(list)
    for at, r in enumerate(rows):
        place[r["source"]].append(at)
    mean = {s: sum(x) / len(x) for s, x in place.items()}
    assert mean["s0"] < mean["s2"]
    assert rows[0].__fields__ == docs.columns


def test_equal_rows_of_two_sources_keep_their_own_copies(spark, table, make):
    rows = [(1, "a b c d", "x"), (1, "a b c d", "y"), (2, make(1, 30), "x"), (3, make(2, 30), "y"), (4, make(3, 30), "y")]
    docs = table(rows)
    want = Counter({(r["doc_id"], r["source"]): r["copies"] for r in mixing.curriculum(docs).collect()})
    assert Counter((r["doc_id"], r["source"]) for r in mixing.arranged(docs).collect()) == +want


def test_rates_add_up_at_each_time(spark):
    sizes = spark.createDataFrame([("a", 50), ("b", 900), ("c", 400), ("d", 1), (None, 70)], "source string, source_size long")
    plan = mixing.targets(sizes).collect()
    total = sum(r["target"] for r in plan)
    for t in (0, 0.3, 1):
        rates = [r["target"] / total * (1 + r["slope"] * (2 * t - 1)) for r in plan]
        assert sum(rates) == pytest.approx(1) and min(rates) >= 0


def test_position_inverts_the_schedule(spark):
    from pyspark.sql import functions as F

    for slope in (-0.5, 0.0, 0.25, 0.5):
        for t in (0.0, 0.3, 1.0):
            done = t + slope * (t * t - t)
            assert spark.range(1).select(mixing.position(F.lit(done), F.lit(slope))).first()[0] == pytest.approx(t)


@pytest.mark.parametrize("n", [5, 24, 500])
def test_shards_are_even_and_keep_groups(spark, table, make, n):
    docs = [(k, make(k % (n // 2 + 1), 8) + (" é" if k % 9 == 0 else "")) for k in range(n)] + [(None, "x"), (9001, make(1, 8)), (9007, None), (9008, None), (9009, "")]
    docs += [(2000 + k, "the same text") for k in range(n // 3)]
    got = sharding.assign(table(docs)).collect()
    assert len(got) == len(docs)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    counts = [len(by[s]) for s in range(24)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    texts = {i: t for i, t in docs}
    for r in got:
        if r["doc_id"] is not None:
            t = texts[r["doc_id"]]
            assert r["size"] == len((t or "").encode()) + 8 and r["text_crc32"] == zlib.crc32((t or "").encode())
    if n == 500:
        shards = defaultdict(set)
        for r in got:
            if r["doc_id"] is not None and r["doc_id"] < 500:
                shards[texts[r["doc_id"]]].add(r["shard"])
        pairs = [t for t, k in Counter(t for i, t in docs if i is not None and i < 500).items() if k > 1]
        assert sum(len(shards[t]) > 1 for t in pairs) <= 23
    assert sharding.assign(table([])).count() == 0


def test_md5_order_is_that_of_the_sql():
    assert hashlib.md5(b"1").hexdigest() == "c4ca4238a0b923820dcc509a6f75849b"
