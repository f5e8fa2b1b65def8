import hashlib
import random

import numpy as np
import pytest

from tallyfold.llm import sketches
from tallyfold.llm.sketches import Sketch


def shingles(text):
    w = (text or "").translate({k: k + 32 for k in range(65, 91)}).split(" ")
    w = [x for x in w if x]
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def check(got, rows, slack):
    """``rows`` have different ids."""
    rows = order(rows)
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1] or ""
        t = t or ""
        changed = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        r = by[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(jaccard(t, changed), abs=slack(t, changed))
        assert r["near_next"] == pytest.approx(jaccard(t, after), abs=slack(t, after))


def test_short_texts_are_exact(spark, table, make):
    """Sets of at most 64 shingles are kept whole."""
    texts = [None, "", "   ", "one", "One", "a b c d", "a b c d e", "A B c d e f", "é\U0001f600 x", "a b c d e f g h"]
    rows = [(3 * k, t) for k, t in enumerate(texts)] + [(1000 + k, make(k // 2, 5 + k % 55)) for k in range(150)] + [(None, "without an id")]
    rows = [(i, t) for i, t in rows]
    random.Random(1).shuffle(rows)
    got = sketches.edited(table(rows).repartition(5)).collect()
    check(got, rows, lambda a, b: 1e-12)
    prints = {}
    for r in got:
        prints.setdefault(dict(rows)[r["doc_id"]] or "", set()).add(r["fingerprint"])
    assert all(len(x) == 1 for x in prints.values())


def test_long_texts_are_near(spark, table, make):
    rows = [(k, make(k % 5, 300 + 500 * (k % 7), words=5000)) for k in range(40)] + [(99, make(9, 400_000, words=90_000))]
    got = sketches.edited(table(rows)).collect()
    check(got, rows, lambda a, b: 0.3)
    wrong = [abs(r["near_edited"] - 1 / 3) for r in got]
    assert np.mean(wrong) < 0.06


def test_order_over_many_ranges(spark, table, make):
    """Ties, ids that aren't in the order of rows, one id that a third of all rows have, and more ranges than rows."""
    for n in (1, 2, 3, 700):
        rows = [((k * 7919) % 10_007, f"{k} text of its own") for k in range(n)]
        got = sketches.edited(table(rows).repartition(7)).collect()
        check(got, rows, lambda a, b: 1e-12)
    rows = [(5 if k % 3 else k, f"{k} words of row {k}") for k in range(300)] + [(None, "none")] * 4
    got = sketches.edited(table(rows)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
    # each row follows another, so each beginning is used once
    ends = sketches.in_order(table(rows)).where("NOT late").count()
    assert ends == len(rows)
    assert sketches.edited(table([])).count() == 0
    alone = sketches.edited(table([(4, "a b c d e f")])).first()
    assert alone["near_next"] == 1.0 and alone["n_chars"] == 11


def test_rerun_is_the_same(spark, table, make):
    rows = [(k % 40, make(k, 80)) for k in range(120)]
    one = sketches.edited(table(rows)).collect()
    assert sorted(map(tuple, one), key=str) == sorted(map(tuple, sketches.edited(table(rows[::-1]).repartition(3)).collect()), key=str)


def test_merged_is_the_sketch_of_the_union():
    rng = np.random.default_rng(0)
    for na, nb in ((10, 20), (10, 50_000), (30_000, 80_000), (0, 100), (0, 0)):
        a, b = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (na, nb))
        both = Sketch.of(a).merged(Sketch.of(b))
        union = np.union1d(a, b)
        assert both.hashes.tolist() == union[union <= np.uint64(both.bound)].tolist()
        again = Sketch.parse(both.text())
        assert again.bound == both.bound and again.hashes.tolist() == both.hashes.tolist()


def test_every_hash_below_the_fraction_is_kept():
    own = np.random.default_rng(2).integers(0, 2**64, 100_000, dtype=np.uint64)
    kept = Sketch.of(own)
    assert set(own[own <= np.uint64(int(2.0**64 / 64))].tolist()) == set(kept.hashes.tolist())
    assert len(Sketch.of(own[:1000]).hashes) == 64


def test_containment_of_unequal_texts(spark, make):
    long = make(1, 30_000, words=20_000)
    inside = " ".join(long.split(" ")[4000:9000])
    docs = spark.createDataFrame([(1, long), (2, inside), (3, make(2, 6000, words=20_000)), (4, None)], "doc_id long, text string")
    prints = sketches.fingerprints(docs)
    one = prints.where("doc_id = 1").select("fingerprint")
    pairs = prints.crossJoin(one.withColumnRenamed("fingerprint", "other"))
    got = {r["doc_id"]: r for r in sketches.compared(pairs, "fingerprint", "other").collect()}
    assert got[2]["a_in_b"] == 1.0 and got[2]["b_in_a"] == pytest.approx(1 / 6, abs=0.04) and got[2]["near"] == pytest.approx(1 / 6, abs=0.04)
    assert got[3]["near"] == 0.0 and got[1]["near"] == 1.0 and got[4]["near"] == 0.0
    assert sketches.compared(spark.createDataFrame([(None, "x")], "a string, b string"), "a", "b").first()["near"] is None


def test_merged_by_key(spark, make):
    texts = [(k, f"s{k % 2}" if k % 5 else None, make(k, 300)) for k in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, source string, text string")
    prints = sketches.fingerprints(docs).join(docs.select("doc_id", "source"), "doc_id")
    got = {r["source"]: Sketch.parse(r["fingerprint"]) for r in sketches.merged(prints.repartition(6), ["source"]).collect()}
    assert set(got) == {"s0", "s1", None}
    for s, found in got.items():
        want = None
        for r in prints.collect():
            if r["source"] == s:
                own = Sketch.parse(r["fingerprint"])
                want = own if want is None else want.merged(own)
        assert found.hashes.tolist() == want.hashes.tolist()
