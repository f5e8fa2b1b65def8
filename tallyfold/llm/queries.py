"""One query for each operator, over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import bpe, forest, infill, lm, minhash, mixing, passages, quality, rules, sharding, sketches, toxicity, whitening

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages that stand elsewhere before."""
    cleaned = passages.cut(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", F.size("cut_spans").alias("n_cut"), "cut_spans", "kept_in", F.length("text").alias("n_chars_left"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from four fifths of the labelled ones."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").where(~_fold(5)))
    found = toxicity.tag(docs, model)
    return found.select(
        "doc_id", _fold(5).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "toxic_words", F.size("spans").alias("n_spans"), "spans"
    )


def op4_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all embeddings."""
    return forest.near_vectors(_table(spark, sf_dir, "embeddings"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document, and where in training; sorted by the first place."""
    plan = mixing.curriculum(_table(spark, sf_dir, "documents")).withColumn("first", F.get("positions", F.lit(0)))
    return mixing.in_order(plan, "first", "mark").select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies", F.round("first", 9).alias("first_position"), F.round(F.get("positions", F.size("positions") - 1), 9).alias("last_position")
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from four fifths of the labelled ones."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels").where(~_fold(5)))
    return quality.score(docs, model).select("doc_id", _fold(5).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents in a public byte-level vocabulary, and back."""
    import public_tokenizers

    return bpe.encode(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, break_at_space=True, ids=False, digests=True
    )


def _fold(of: int, id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves no remainder; a row without an id isn't held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % of == 0, F.lit(False))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal row counts, equal texts together."""
    return sharding.assign(_table(spark, sf_dir, "documents"))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of quality on all documents, with cutoffs that all labelled ones vouch for."""
    return rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of all documents under what nine tenths of them teach."""
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", _fold(10))
    return lm.score(docs, ~F.col("held_out"), carry=("held_out",))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of all embeddings, on the eight components of the largest variance."""
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op12_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return sketches.edited(_table(spark, sf_dir, "documents"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their middle last, as digests, and as digests of what is rebuilt from that."""
    made = infill.transform(_table(spark, sf_dir, "documents"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_minhash": op1_minhash,
    "op2_passages": op2_passages,
    "op3_toxicity": op3_toxicity,
    "op4_forest": op4_forest,
    "op5_mixing": op5_mixing,
    "op6_quality": op6_quality,
    "op7_bpe": op7_bpe,
    "op8_sharding": op8_sharding,
    "op9_rules": op9_rules,
    "op10_lm": op10_lm,
    "op11_whitening": op11_whitening,
    "op12_sketches": op12_sketches,
    "op13_infill": op13_infill,
    "pipeline": pipeline,
}

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"



def _rules_sql() -> str:
    """The rules and their cutoffs over plain counts."""
    value = {"symbols": "n_symbols / greatest(word_chars, 1)", "repeats": "n_repeat_words / greatest(n_words, 1)", "dup_lines": "100 * n_dup_lines / greatest(n_words, 1)"}
    steps, strata, level = rules.STEPS, len(rules.STRATA) + 1, rules.DOUBT / (len(rules.STRATA) + 1)
    first = {
        r: f"{steps + 1} - (" + " + ".join(f"CAST({value.get(r, 'word_chars / greatest(n_words, 1)')} {'>' if way == 'above' else '<'} {c} AS INTEGER)" for c in tried) + ")"
        for r, (way, tried) in rules.RULES.items()
    }
    least = rules.least_labels(rules.RISK, level)
    pools = ["c0 AS (SELECT *, 0 AS p0, n0 AS a0 FROM n)"]
    for k in range(1, strata):
        pools.append(f"c{k} AS (SELECT *, p{k - 1} + CAST(a{k - 1} >= {least} AS INTEGER) AS p{k}, CASE WHEN a{k - 1} >= {least} THEN 0 ELSE a{k - 1} END + n{k} AS a{k} FROM c{k - 1})")
    last = strata - 1
    ends = " UNION ALL ".join(f"SELECT {k} AS stratum, n{k} AS n, CASE WHEN p{k} = p{last} AND a{last} < {least} THEN greatest(p{last} - 1, 0) ELSE p{k} END AS pool FROM c{last}" for k in range(strata))
    risk = rules.RISK
    return rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT k, i, array_to_string(w[i:i+7], ' ') AS s FROM (SELECT k, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
r AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, s) AS c FROM g) WHERE c > 1),
cov AS (SELECT k, count(DISTINCT i + j) AS n FROM r, range(0, 8) AS o(j) GROUP BY k),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
    coalesce(cov.n, 0) AS n_repeat_words FROM d LEFT JOIN cov USING (k)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, CAST({" + ".join(f"(n_words >= {x})::INTEGER" for x in rules.STRATA)} AS INTEGER) AS stratum,
    {", ".join(f"{sql} AS at_{r}" for r, sql in first.items())} FROM m),
h AS (SELECT stratum, least({", ".join(f"at_{r}" for r in first)}) AS at FROM f WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
n AS (SELECT {", ".join(f"count(*) FILTER (stratum = {k}) AS n{k}" for k in range(strata))} FROM h),
{", ".join(pools)},
p AS ({ends}),
q AS (SELECT p.stratum, (SELECT sum(n) FROM p AS o WHERE o.pool = p.pool) AS n, s.step, (SELECT count(*) FROM h JOIN p AS o USING (stratum) WHERE o.pool = p.pool AND h.at <= s.step) AS x FROM p, range(1, {steps + 1}) AS s(step)),
v AS (SELECT stratum, step, n < {least} OR (SELECT sum(exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln({risk}) + (n - i) * ln(1 - {risk}))) FROM range(0, x + 1) AS t(i)) > {level} AS bad FROM q),
c AS (SELECT stratum, coalesce(min(step) FILTER (bad) - 1, {steps}) AS step FROM v GROUP BY stratum),
j AS (SELECT f.*, CASE WHEN base_failed THEN 'base' {" ".join(f"WHEN at_{r} <= step THEN '{r}'" for r in first)} END AS rejected_by FROM f JOIN c USING (stratum))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, rejected_by IS NULL AS kept, stratum, rejected_by FROM j
"""


ORACLE_SQL: dict[str, str] = {
    "op1_minhash": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_sort(list_distinct([array_to_string(ws[i:i+4], ' ') FOR i IN range(1, len(ws) - 3)])) END AS sh
  FROM w),
sets AS (SELECT min(doc_id) AS rep, sh, len(sh) AS n FROM s WHERE len(sh) > 0 GROUP BY sh),
e AS (SELECT rep, n, unnest(sh) AS g FROM sets),
p AS (
  SELECT a.rep AS a, b.rep AS b, count(*) AS n2, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM e a JOIN e b ON a.g = b.g AND a.rep < b.rep GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * n2 >= 75 * (na + nb - n2)),
two AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT rep AS v, rep AS c FROM sets UNION SELECT reach.v, two.b FROM reach JOIN two ON reach.c = two.a),
comp AS (SELECT v, min(c) AS c FROM reach GROUP BY v)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(comp.c, s.doc_id) AS component_id, coalesce(comp.c, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN sets ON s.sh = sets.sh LEFT JOIN comp ON comp.v = sets.rep
""",
    "op4_forest": """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS k, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
s AS (SELECT * FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
p AS (SELECT a.k AS a, b.k AS b FROM s a JOIN s b ON len(a.x) = len(b.x) AND a.k <> b.k WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a),
reach AS (SELECT k, k AS o FROM v UNION SELECT reach.k, p.b FROM reach JOIN p ON reach.o = p.a),
c AS (SELECT reach.k, min(v.vec_id) AS component_id FROM reach JOIN v ON v.k = reach.o GROUP BY reach.k)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c USING (k) LEFT JOIN n ON n.a = v.k
""",
    "op5_mixing": r"""
WITH d AS (SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS o FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place FROM s),
w AS (SELECT *, [5.0, 2.0, 1.0][1 + place % 3]::DOUBLE AS weight, [-0.5, 0.25, 0.5][1 + place % 3]::DOUBLE AS slope, sum(source_size) OVER () AS total FROM n),
f AS (SELECT *, 3 * source_size / weight AS fullness FROM w),
l AS (SELECT *, (total - coalesce(sum(3 * source_size) OVER (ORDER BY fullness, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY fullness, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM f),
line AS (SELECT arg_min(lv, fullness) AS line FROM l WHERE fullness > lv),
g AS (SELECT source, source_size, slope, CASE WHEN source_size = 0 THEN 0.0 WHEN fullness <= line THEN 3.0 * source_size ELSE line * weight END::DOUBLE AS target FROM l, line),
t AS (SELECT source, source_size, target, slope - sum(target * slope) OVER () / greatest(sum(target) OVER (), 1.0) AS slope FROM g),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.slope, d.source,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY o, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + d.size / 2 AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, CASE WHEN size = 0 THEN [] ELSE list_transform(list_filter([middle, middle + source_size, middle + 2 * source_size], lambda x: x < target),
    lambda x: 2 * (x / target) / (1 - slope + sqrt(greatest(0.0, (1 - slope) * (1 - slope) + 4 * slope * (x / target))))) END AS spots FROM p)
SELECT doc_id, size, source_size, target, CAST(len(spots) * size AS BIGINT) AS taken, source, CAST(len(spots) AS INTEGER) AS copies, round(spots[1], 9) AS first_position, round(spots[-1], 9) AS last_position FROM c
""",
    "op9_rules": _rules_sql(),
    "op13_infill": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (SELECT *, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN z - a END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || substring(t, 1, a) || '<S>' || substring(t, z + 1) || '<M>' || substring(t, a + 1, z - a)
    WHEN 'spm' THEN '<S>' || substring(t, z + 1) || '<P>' || substring(t, 1, a) || '<M>' || substring(t, a + 1, z - a) ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM c
""",
}
