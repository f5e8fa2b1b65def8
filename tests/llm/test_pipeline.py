import hashlib
import os

import duckdb
import pytest

import corpus_pipeline
from tallyfold.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n, seen = docs.count(), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        seen[name] = out.cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs = out
    kept = {k: {r["doc_id"] for r in v.select("doc_id").collect()} for k, v in seen.items()}
    names = [k for k, _ in corpus_pipeline.STAGES]
    for a, b in zip(names, names[1:], strict=False):
        assert kept[b] <= kept[a]
    assert 0 < len(kept[names[1]]) < len(kept[names[0]]) <= n
    mixed = seen["mixing"].select("text").collect()
    assert sorted(r["decoded_sha256"] for r in seen["BPE"].collect()) == sorted(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in mixed)
    texts = [r["text"] for r in seen["substring dedup"].collect()]
    long_lines = [x for t in texts for x in t.split("\n") if len(x.split()) >= 32]
    assert len(long_lines) == len(set(long_lines))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    df = queries.QUERIES[name](spark, SF)
    rel = c.sql(queries.ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(x) for x in cols]
    assert sorted(repr(tuple(r[x] for x in cols)) for r in df.collect()) == sorted(repr(tuple(r[k] for k in at)) for r in rel.fetchall())


def test_registered():
    import __spark_entry__

    found = __spark_entry__.queries()
    assert [n for n in range(1, 14) if not any(k.startswith(f"op{n}_") for k in found)] == []
    assert "pipeline" in found


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, kept_in string, cut_spans string, row int, __mark string, score string, kept string"


def odd_rows(make):
    """Nulls, empty texts, repeated rows and ids, ties, a very long text, passages that several documents hold."""
    one, two, shared = make(1, 80), make(2, 80), make(3, 60)
    texts = [(3, one), (5, one), (5, two), (9, make(4, 120)), (None, None), (None, make(5, 60)), (10, ""), (10, ""), (11, None), (12, " \n\t "), (13, make(6, 80) + "\n" + shared), (14, make(7, 80) + "\n" + shared), (15, make(8, 90)), (15, make(8, 90))]
    texts += [(40 + k, make(20 + k, 70)) for k in range(25)] + [(99, make(9, 150_000, 90_000))]
    return [(i, t, "en", f"s{k % 3}" if k % 5 else None, len(t or ""), "mine", "mine", k, "mine", "mine", "mine") for k, (i, t) in enumerate(texts)]


@pytest.fixture
def labels(spark, tmp_path, make):
    """Learned labels that leave no document of ``odd_rows`` out: every text is a good one but those of few words."""
    rows = [(i, 1, 0) for i in range(0, 100)] + [(10, 0, 0), (11, 0, 0)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("k", range(5))
def test_each_stage_takes_odd_tables(spark, make, labels, k):
    docs = spark.createDataFrame(odd_rows(make), CLASHING)
    name, stage = corpus_pipeline.STAGES[k]
    got = stage(spark, docs, labels)
    rows = got.collect()
    if k == 4:
        assert len(rows) == docs.count()
        return
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    assert all(r[c] == "mine" for r in rows for c in ("kept_in", "cut_spans", "__mark", "score", "kept"))
    by_row = {r["row"]: r for r in docs.collect()}
    if name != "substring dedup":
        assert all(r["text"] == by_row[r["row"]]["text"] for r in rows)
    if name == "MinHash near-dedup":
        ids = [(r["doc_id"], r["text"]) for r in rows]
        assert (3, make(1, 80)) in ids and (5, make(2, 80)) in ids and (5, make(1, 80)) not in ids
        assert sum(i == 15 for i, _ in ids) == 1 and sum(i == 10 for i, _ in ids) == 2
    if name == "substring dedup":
        texts = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] in (13, 14, 99)}
        assert make(3, 60) in texts[13] and make(3, 60) not in texts[14] and len(texts[99].split()) == 150_000
        assert sum(r["n_chars"] != len(r["text"] or "") for r in rows) == 0


@pytest.mark.parametrize("k", range(5))
def test_each_stage_takes_an_empty_table(spark, labels, k):
    empty = spark.createDataFrame([], CLASHING)
    got = corpus_pipeline.STAGES[k][1](spark, empty, labels)
    assert got.count() == 0 and (k == 4 or got.columns == empty.columns)
