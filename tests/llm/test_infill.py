import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from tallyfold.llm import infill


def expected(doc_id, text):
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:z], text[z:]
    return (doc_id, n, "spm", a, z - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (doc_id, n, "psm", a, z - a, f"<P>{p}<S>{s}<M>{m}")


def test_equal_to_plain_python(spark, table, make):
    texts = [None, "", " ", "  ", "a", "é", "é \U0001f600日本", "\r\n\t\x0b\x00x", "<P", "a <P> b", "<S>", "x<M>y", "S>P>M>", "<<", "<S <M <", " a\u0085b", "w" * 3000, "日本語" * 500, "two  spaces   three "]
    rows = [(k, t) for k, t in enumerate(texts * 6)] + [(None, "no id at all"), (None, "no id at all"), (7, "again"), (7, "again")]
    rows += [(1000 + k, make(k, 1 + 7 * k)) for k in range(60)] + [(5000, make(3, 60_000))]
    got = infill.transform(table(rows))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    want = sorted((expected(i, t) for i, t in rows), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    back = got.select("doc_id", infill.restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)


def test_marks_at_the_edges_of_slices_are_told_apart(spark):
    """Slices that end or begin with parts of a mark."""
    bits = ["<", "<S", "S>", ">", "<P", "M>", ""]
    rows = [(f"<P>{p}<S>{s}<M>{m}", "psm", p + m + s) for p in bits for s in bits for m in bits] + [(f"<S>{s}<P>{p}<M>{m}", "spm", p + m + s) for p in bits for s in bits for m in bits]
    got = spark.createDataFrame(rows, "output string, form string, want string").select("want", infill.restored(F.col("output"), F.col("form")).alias("got")).collect()
    assert all(r["got"] == r["want"] for r in got)


def test_offsets_are_those_of_code_points():
    texts = ["", "a b", " x ", "\U0001f600 é  z", "q" * 700 + " " + "日" * 300]
    found = infill.Ruler().measure(pa.array(texts))
    assert found.n.tolist() == [len(t) for t in texts]
    assert all(found.offset(d, k) == k for d, t in enumerate(texts) for k in range(len(t) + 1))
    later = infill.Ruler().measure(pa.array(["zz zz", *texts])[1:])
    assert later.n.tolist() == [len(t) for t in texts] and later.offset(4, 705) == 705


def test_shares_of_forms_and_empty_table(spark, table):
    got = infill.transform(table([(k, "some words to cut") for k in range(3000)])).groupBy("form").count().collect()
    n = {r["form"]: r["count"] for r in got}
    assert abs(n["plain"] / 3000 - 0.1) < 0.03 and abs(n["spm"] / 3000 - 0.18) < 0.03
    assert infill.transform(table([])).count() == 0
