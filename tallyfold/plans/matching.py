"""Cleaning and matching of texts over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions import text as T
from tallyfold.functions.numbers import rate
from tallyfold.operators import matching as M
from tallyfold.operators.records import Step, Steps, extract_fields, from_source, has_valid_body
from tallyfold.plans.adapters import NAMES, RAW, REMOVED, SHORT, SOURCES, STRICT_SHORT, TAGGED, mention_sql, raw, tagged
from tallyfold.plans.registry import query, table

_TARGETS = ["src1", "src3", "src7", "src12"]
_IN = "lower(coalesce(subreddit, '')) IN ('src1', 'src3', 'src7', 'src12')"
_VALID = "body IS NOT NULL AND body NOT IN ('', '[deleted]', '[removed]')"


@query("valid_body", f"WITH {RAW} SELECT id, md5(body) AS body_md5 FROM raw WHERE {_VALID}")
def _(spark, d):
    return raw(spark, d).where(has_valid_body()).select("id", F.md5("body").alias("body_md5"))


@query("target_source", f"WITH {RAW} SELECT id, subreddit FROM raw WHERE {_IN}")
def _(spark, d):
    return raw(spark, d).where(from_source(_TARGETS)).select("id", "subreddit")


def _steps() -> Steps:
    return Steps(Step("source", from_source(_TARGETS)), Step("body", has_valid_body()), Step("long", F.length("body") >= 500))


@query(
    "reject_stats",
    f"""WITH {RAW}, r AS (SELECT CASE WHEN NOT ({_IN}) THEN 'source' WHEN NOT ({_VALID}) THEN 'body' WHEN NOT (length(body) >= 500) THEN 'long' END AS reason FROM raw)
SELECT count(*) AS total, count(*) FILTER (reason IS NULL) AS accepted, count(*) FILTER (reason = 'source') AS rejected_source, count(*) FILTER (reason = 'body') AS rejected_body, count(*) FILTER (reason = 'long') AS rejected_long FROM r""",
)
def _(spark, d):
    return _steps().stats(raw(spark, d))


@query("accepted_records", f"WITH {RAW} SELECT id, subreddit FROM raw WHERE {_IN} AND {_VALID} AND length(body) >= 500")
def _(spark, d):
    return _steps().accepted(raw(spark, d)).select("id", "subreddit")


@query(
    "project_fields",
    f"WITH {RAW} SELECT CAST(id AS VARCHAR) AS id, md5(body) AS body, NULL::VARCHAR AS author, NULL::VARCHAR AS author_flair_text, NULL::VARCHAR AS author_flair_css_class, subreddit, NULL::BIGINT AS created_utc, NULL::BIGINT AS score, NULL::BIGINT AS controversiality, NULL::VARCHAR AS parent_id, NULL::VARCHAR AS link_id FROM raw",
)
def _(spark, d):
    return extract_fields(raw(spark, d)).withColumn("body", F.md5("body"))


@query("entity_mentions", f"SELECT doc_id, array_to_string({mention_sql('text')}, ',') AS mentioned FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(M.mentions(F.col("text"), NAMES, SHORT), ",").alias("mentioned"))


@query("mention_filter", f"WITH m AS (SELECT doc_id, {mention_sql('text')} AS x FROM documents) SELECT doc_id, len(x) AS n FROM m WHERE len(x) > 0")
def _(spark, d):
    # a row of its own for the matches, so that the filter doesn't work them out again
    found = table(spark, d, "documents").select("doc_id", F.explode(F.array(M.mentions(F.col("text"), NAMES, SHORT))).alias("m"))
    return found.select("doc_id", F.size("m").cast("long").alias("n")).where("n > 0")


@query(
    "strict_vs_loose",
    f"""WITH m AS (SELECT unnest({mention_sql('text')}) AS name, 1 AS loose, 0 AS strict FROM documents UNION ALL SELECT unnest({mention_sql('text', short=STRICT_SHORT, removed=REMOVED)}), 0, 1 FROM documents)
SELECT name, CAST(sum(loose) AS BIGINT) AS loose, CAST(sum(strict) AS BIGINT) AS strict FROM m GROUP BY name""",
)
def _(spark, d):
    c = F.col("text")
    docs = table(spark, d, "documents").select(M.mentions(c, NAMES, SHORT).alias("a"), M.mentions(c, NAMES, STRICT_SHORT, REMOVED).alias("b"))
    one = docs.select(F.explode(F.array_union("a", "b")).alias("name"), "a", "b")
    return one.groupBy("name").agg(F.count_if(F.array_contains("a", F.col("name"))).alias("loose"), F.count_if(F.array_contains("b", F.col("name"))).alias("strict"))


_B = r"[^\p{L}\p{M}\p{Nd}\p{Pc}]"


@query("any_mention_rate", rf"SELECT lang, count(*) AS n, count(*) FILTER (regexp_matches(text, '(?i)(^|{_B})(idiot|und|que)($|{_B})')) AS hits, round(count(*) FILTER (regexp_matches(text, '(?i)(^|{_B})(idiot|und|que)($|{_B})')) / count(*), 4) AS mention_rate FROM documents GROUP BY lang")
def _(spark, d):
    hit = T.any_bounded(F.col("text"), ["idiot", "und", "que"])
    by = table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"))
    return by.withColumn("mention_rate", rate(F.col("hits"), F.col("n")))


@query("word_boundary", rf"SELECT doc_id, contains(lower(text), 'an') AS inside, regexp_matches(text, '(?i)(^|{_B})an($|{_B})') AS bounded FROM documents")
def _(spark, d):
    c = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.lower(c).contains("an").alias("inside"), T.bounded(c, "an").alias("bounded"))


_TEAM_CASE = "CASE " + " ".join(f"WHEN contains(lower(tag), '{a}') THEN '{n}'" for a, n in sorted(M.alias_map(SOURCES).items(), key=lambda kv: -len(kv[0]))) + " END"


@query("team_from_flair", f"WITH {TAGGED} SELECT id, {_TEAM_CASE} AS team FROM tagged")
def _(spark, d):
    return M.with_longest_alias(tagged(spark, d), "tag", SOURCES).select("id", "team")


@query("flair_pattern_class", f"WITH {TAGGED} SELECT CASE WHEN regexp_matches(tag, '^:[\\w-]+:') THEN 'emoji' WHEN regexp_matches(tag, '^\\[[A-Z]{{3}}\\]') THEN 'bracket' ELSE 'other' END AS form, count(*) AS n FROM tagged WHERE tag IS NOT NULL GROUP BY 1")
def _(spark, d):
    return tagged(spark, d).where("tag IS NOT NULL").groupBy(T.tag_form(F.col("tag")).alias("form")).agg(F.count("*").alias("n"))


_CODE = r"upper(coalesce(nullif(regexp_extract(tag, '^:(\w{2,4})-\d+:', 1), ''), nullif(regexp_extract(tag, '^\[([A-Z]{3})\]', 1), ''), nullif(regexp_extract(tag, '^:bw-(\w{2,4}):', 1), '')))"


@query("code_extract", f"WITH {TAGGED} SELECT id, {_CODE} AS code FROM tagged")
def _(spark, d):
    return tagged(spark, d).select("id", T.tag_code(F.col("tag")).alias("code"))


@query("legacy_code_map", f"WITH {TAGGED}, m(code, current) AS (VALUES ('EN', 'English'), ('DE', 'German'), ('ABC', 'Alphabet')) SELECT current, count(*) AS n FROM tagged JOIN m ON m.code = {_CODE} GROUP BY current")
def _(spark, d):
    codes = spark.createDataFrame([("EN", "English"), ("DE", "German"), ("ABC", "Alphabet")], "code string, current string")
    return tagged(spark, d).select(T.tag_code(F.col("tag")).alias("code")).join(F.broadcast(codes), "code").groupBy("current").agg(F.count("*").alias("n"))


@query("unresolved_values", f"WITH {TAGGED} SELECT tag, count(*) AS n FROM tagged WHERE tag IS NOT NULL AND lower(tag) NOT IN (SELECT lower(source) FROM documents WHERE source <> 'src5') GROUP BY tag ORDER BY n DESC, tag LIMIT 20")
def _(spark, d):
    names = [M.Name(f"src{i}") for i in range(20) if i != 5]
    return M.unresolved(tagged(spark, d), "tag", M.alias_table(spark, names), 20)


@query("containment_join", f"WITH {TAGGED}, l AS (SELECT tag AS label, count(*) AS n FROM tagged WHERE tag IS NOT NULL GROUP BY tag), m AS (SELECT DISTINCT source AS name FROM documents) SELECT name, count(label) AS labels, CAST(coalesce(sum(n), 0) AS BIGINT) AS times FROM m LEFT JOIN l ON contains(lower(label), lower(name)) GROUP BY name")
def _(spark, d):
    labels = tagged(spark, d).where("tag IS NOT NULL").groupBy(F.col("tag").alias("label")).agg(F.count("*").alias("n"))
    return M.containment(table(spark, d, "documents").select(F.col("source").alias("name")).distinct(), labels, "name", "label", "n")


@query("scalar_text_mix", r"SELECT doc_id, lower(source) AS low, upper(source) AS up, length(text) AS chars, contains(text, 'the') AS has_the, left(text, 12) AS head, replace(source, 'src', 's-') AS short, starts_with(text, 'The') AS starts, ends_with(text, '.') AS ends, trim(concat('  ', source, ' ')) AS bare, len(string_split(text, ' ')) AS parts, string_split(text, ' ')[1] AS first FROM documents")
def _(spark, d):
    c = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id", F.lower("source").alias("low"), F.upper("source").alias("up"), F.char_length(c).cast("long").alias("chars"), c.contains("the").alias("has_the"), F.substring(c, 1, 12).alias("head"), F.replace("source", F.lit("src"), F.lit("s-")).alias("short"), c.startswith("The").alias("starts"), c.endswith(".").alias("ends"), T.stripped(F.concat(F.lit("  "), "source", F.lit(" "))).alias("bare"), F.size(F.split(c, " ")).cast("long").alias("parts"), F.get(F.split(c, " "), 0).alias("first")
    )


@query(
    "predicate_mix",
    "SELECT doc_id, n_chars BETWEEN 50 AND 300 AS between_, source IN ('src1', 'src2') AS in_, source NOT IN ('src1', 'src2') AS not_in, list_contains(string_split(text, ' '), 'the') AS has_word, NOT regexp_matches(text, '[0-9]{3}') AS no_digits, lang IS NOT NULL AND source IS NOT NULL AS both FROM documents".replace(" AS both ", ' AS "both" '),
)
def _(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.col("n_chars").between(50, 300).alias("between_"), F.col("source").isin("src1", "src2").alias("in_"), (~F.col("source").isin("src1", "src2")).alias("not_in"), F.array_contains(F.split("text", " "), "the").alias("has_word"), (~F.col("text").rlike("[0-9]{3}")).alias("no_digits"), (F.col("lang").isNotNull() & F.col("source").isNotNull()).alias("both")
    )


@query("length_buckets", "SELECT CASE WHEN n_chars < 20 THEN '<20' WHEN n_chars < 50 THEN '20-49' WHEN n_chars < 100 THEN '50-99' WHEN n_chars < 200 THEN '100-199' ELSE '200+' END AS bucket, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM documents GROUP BY 1")
def _(spark, d):
    from tallyfold.operators.profile import shares

    return shares(table(spark, d, "documents").groupBy(T.length_bucket(F.col("n_chars")).alias("bucket")).agg(F.count("*").alias("n")))


@query(
    "rederive_delta",
    f"WITH a AS (SELECT {mention_sql('text')} AS x, {mention_sql('text', short=STRICT_SHORT, removed=REMOVED)} AS y FROM documents) SELECT count(*) AS total, count(*) FILTER (len(x) > 0) AS before_rows, count(*) FILTER (len(y) > 0) AS after_rows, CAST(sum(len(x)) AS BIGINT) AS before_mentions, CAST(sum(len(y)) AS BIGINT) AS after_mentions FROM a",
)
def _(spark, d):
    c = F.col("text")
    both = table(spark, d, "documents").select(F.size(M.mentions(c, NAMES, SHORT)).alias("x"), F.size(M.mentions(c, NAMES, STRICT_SHORT, REMOVED)).alias("y"))
    return both.agg(F.count("*").alias("total"), F.count_if(F.col("x") > 0).alias("before_rows"), F.count_if(F.col("y") > 0).alias("after_rows"), F.sum("x").alias("before_mentions"), F.sum("y").alias("after_mentions"))
