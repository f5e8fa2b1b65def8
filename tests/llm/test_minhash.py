import random

import numpy as np
import pyarrow as pa
import pytest

from tallyfold.llm import minhash, passages, tokens
from tallyfold.llm.graph import components
from tallyfold.llm.store import Store


def words(t):
    return (t or "").encode().lower().split()


def shingle_set(t, size=5):
    w = words(t)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def brute(items):
    """items: (vertex, set) -> smallest vertex reachable by links."""
    up = {v: v for v, _ in items}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v

    for i, (a, x) in enumerate(items):
        for b, y in items[:i]:
            both = len(x & y)
            if both and 100 * both >= 75 * (len(x) + len(y) - both):
                p, q = sorted((root(a), root(b)))
                up[q] = p
    return {v: root(v) for v, _ in items}


def near_copies(make, n_groups=6, size=8, length=60):
    r = random.Random(5)
    out = []
    for g in range(n_groups):
        base = make(g, length).split()
        for _ in range(size):
            w = list(base)
            for _ in range(r.randrange(0, 5)):
                w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
            out.append(" ".join(w))
    return out


def test_words_are_those_of_the_definition():
    texts = ["", None, " A b\tC\x0bd\n\x1fe \x85f ", "Éa b c", "x"]
    buf, off = tokens.buffers(pa.array(texts))
    w = tokens.words(buf, off)
    assert [len(words(t)) for t in texts] == np.diff(w.first).tolist()
    spans = [bytes(w.buf[a:b]) for a, b in zip(w.start, w.end, strict=True)]
    assert spans == [x for t in texts for x in words(t)]
    assert len(set(w.hash.tolist())) == len(set(spans))


def test_shingles_and_chunks():
    r = random.Random(1)
    texts = [" ".join(r.choice("abc") for _ in range(r.randrange(0, 30))) for _ in range(200)]
    for limit in (10, 100, 10**6):
        buf, off = tokens.buffers(pa.array(texts))
        sizes = []
        for lo, hi in tokens.chunks(off, limit):
            runs, first = tokens.shingles(tokens.words(buf, off[lo : hi + 1]), 5)
            sizes += [len(set(runs[a:b].tolist())) for a, b in zip(first, first[1:], strict=False)]
        assert sizes == [len(shingle_set(t)) for t in texts]


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**63, 1000).astype(np.uint64)
    y = np.concatenate([x[:800], rng.integers(0, 2**63, 200).astype(np.uint64)])
    got = minhash.signatures(np.concatenate([x, y, x, x]), np.array([0, 1000, 1000, 2000, 4000]), 2000)
    assert abs((got[0] == got[2]).mean() - 800 / 1200) < 0.05
    assert (got[0] == got[3]).all() and (got[1] == 0xFFFFFFFF).all()


def test_near_duplicates_equal_brute_force(spark, table, make):
    texts = near_copies(make) + ["", None, " \n", "one two", "One TWO", "one two three"] + [make(99, 50)] * 5
    rows = list(enumerate(texts)) + [(None, texts[0]), (7, texts[7])]
    got = minhash.near_duplicates(table(rows)).collect()
    assert len(got) == len(rows)
    want = brute([(i, shingle_set(t)) for i, t in enumerate(texts)])
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]] and r["n_shingles"] == len(shingle_set(texts[r["doc_id"]])) and r["kept"] == (r["doc_id"] == r["component_id"])


@pytest.mark.parametrize("direct", [0, 4])
def test_links_that_the_star_misses(spark, table, make, monkeypatch, direct):
    """A chain in which neighbours are linked and others aren't; small blocks, with and without crowded ones."""
    monkeypatch.setattr(minhash, "DIRECT", direct)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    base = make(3, 100).split()
    chain = [" ".join(base[6 * k :] + [f"e{j}" for j in range(6 * k)]) for k in range(10)]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(table(list(enumerate(chain)))).collect()}
    assert got == brute([(i, shingle_set(t)) for i, t in enumerate(chain)])


def test_empty_table(spark, table):
    assert minhash.near_duplicates(table([])).count() == 0
    assert passages.cut(table([])).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(5, 5), (41, 100 - 1)]
    got = {r["v"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), Store(spark, "t")).collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[k] == 100 for k in range(100, 130)) and got[99] == 41


def test_rows_of_one_id_stand_for_themselves(spark, table, make):
    """Two texts of id 5; each is the near copy of another document."""
    one, two = make(1, 80), make(2, 80)
    rows = [(5, one), (5, two), (7, one + " more"), (3, two + " more"), (9, make(4, 80)), (9, make(5, 80))]
    got = sorted((r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(table(rows)).collect())
    assert got == [(3, 3), (5, 3), (5, 5), (7, 5), (9, 9), (9, 9)]


def test_a_very_long_text(spark, table, make, monkeypatch):
    """A text of many pieces has the words that it has as a whole, and links like others."""
    monkeypatch.setattr(tokens, "CHUNK_BYTES", 1000)
    long = make(8, 20_000)
    buf, off = tokens.buffers(pa.array(["x", long, "", "y" * 5000 + " z"]))
    w, whole = tokens.words(buf, off), tokens._words(buf, off, True)
    assert all((getattr(w, k) == getattr(whole, k)).all() for k in ("hash", "start", "end", "first", "buf", "off"))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(table([(1, long), (2, long + " end"), (3, make(9, 300))])).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_representatives_keep_one_row_of_each_group(spark, make):
    """Repeated ids, repeated rows, texts that differ in white space only, and columns named like the operator's own."""
    one, two, three = make(1, 80), make(2, 80), make(3, 80)
    rows = [(3, one), (5, one), (5, two), (9, three), (7, two + " more"), (9, three.replace(" ", "  ")), (11, ""), (11, ""), (11, None), (None, one), (12, make(4, 80)), (12, make(4, 80)), (9, three)]
    docs = spark.createDataFrame([(i, t, k, "x") for k, (i, t) in enumerate(rows)], "doc_id long, text string, group int, kept string")
    got = minhash.representatives(docs)
    assert got.columns == docs.columns
    stay = [(r["doc_id"], r["text"], r["kept"]) for r in got.collect()]
    assert len(stay) == 8 and all(k == "x" for _, _, k in stay)
    assert sorted(((i, t) for i, t, _ in stay if i not in (9, 11)), key=str) == sorted([(3, one), (5, two), (None, one), (12, make(4, 80))], key=str)
    assert sum(i == 11 for i, _, _ in stay) == 3
    assert [t.replace("  ", " ") for i, t, _ in stay if i == 9] == [three]
    assert minhash.representatives(docs.limit(0)).count() == 0
