"""Requests, replies, attribution and cost over events and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.numbers import duration_text, percent_text, signed_text, size_text, token_cost, tokens_of_chars
from tallyfold.functions.text import batch_number
from tallyfold.operators import labels as L
from tallyfold.operators import polarity as P
from tallyfold.operators import matching as M
from tallyfold.operators import metrics
from tallyfold.operators.profile import value_counts
from tallyfold.plans.adapters import RESULTS, results
from tallyfold.plans.registry import query, table
from tallyfold.state import downloadable, pending, to_submit

_PARSED = f"""WITH {RESULTS}, done AS (SELECT * FROM results WHERE result_type = 'succeeded'),
labels AS (SELECT custom_id AS id, CASE WHEN form <= 3 THEN s ELSE 'error' END AS sentiment, CASE WHEN form <= 3 THEN c ELSE 0.0 END AS confidence, CASE WHEN form <= 3 THEN p END AS label_entity, input_tokens, output_tokens FROM done)"""


@query("parse_replies", f"{_PARSED} SELECT * FROM labels")
def _(spark, d):
    return L.labels_of(results(spark, d))


@query("dead_letters", f"WITH {RESULTS} SELECT result_type, count(*) AS n FROM results WHERE result_type <> 'succeeded' GROUP BY result_type")
def _(spark, d):
    return value_counts(L.dead_letters(results(spark, d)), "result_type")


@query(
    "build_requests",
    "SELECT CAST(doc_id AS VARCHAR) AS custom_id, 'm-1' AS model, 64 AS max_tokens, 0.0::DOUBLE AS temperature, 'user' AS role, md5('"
    + L._BEFORE.replace("'", "''")
    + "' || text || '"
    + L._AFTER.replace("'", "''")
    + "') AS content_md5 FROM documents",
)
def _(spark, d):
    r = L.requests(table(spark, d, "documents"), "m-1", key="doc_id", body="text")
    m = F.col("params.messages")[0]
    return r.select("custom_id", "params.model", "params.max_tokens", "params.temperature", m["role"].alias("role"), F.md5(m["content"]).alias("content_md5"))


@query("batch_split", "SELECT *, CAST((row_number() OVER (ORDER BY event_id) - 1) // 700 + 1 AS INTEGER) AS batch_num FROM events")
def _(spark, d):
    return L.numbered(table(spark, d, "events"), "event_id", 700)


@query("batch_file_counts", "SELECT CAST((k - 1) // 300 + 1 AS INTEGER) AS batch_num, count(*) AS n FROM (SELECT row_number() OVER (ORDER BY doc_id) AS k FROM documents) GROUP BY 1")
def _(spark, d):
    return value_counts(L.numbered(table(spark, d, "documents"), "doc_id", 300), "batch_num")


_COMMENTS = "comments AS (SELECT CASE WHEN event_id % 5 = 0 THEN 'x' ELSE '' END || event_id AS id, event_type AS body, user_id AS score FROM events)"


def _comments(spark, d):
    e = table(spark, d, "events")
    null = F.lit(None).cast("string")
    return e.select(
        # some are known by another key than their labels
        F.concat(F.when(F.col("event_id") % 5 == 0, "x").otherwise(""), F.col("event_id").cast("string")).alias("id"),
        F.col("event_type").alias("body"),
        null.alias("author"),
        null.alias("author_flair_text"),
        null.alias("author_flair_css_class"),
        F.lit(0).cast("long").alias("created_utc"),
        F.col("user_id").alias("score"),
        F.array(F.concat(F.lit("user "), F.col("user_id").cast("string"))).alias("mentioned_entities"),
    )


@query("labels_join", f"{_PARSED}, {_COMMENTS} SELECT id AS comment_id, body, score, sentiment, confidence, label_entity, input_tokens, output_tokens FROM comments JOIN labels USING (id)")
def _(spark, d):
    joined = L.labelled(_comments(spark, d), L.labels_of(results(spark, d)))
    return joined.select("comment_id", "body", "score", "sentiment", "confidence", "label_entity", "input_tokens", "output_tokens")


@query("dropped_labels", f"{_PARSED}, {_COMMENTS} SELECT sentiment, count(*) AS n FROM labels WHERE id NOT IN (SELECT id FROM comments) GROUP BY sentiment")
def _(spark, d):
    return value_counts(L.dropped_labels(_comments(spark, d), L.labels_of(results(spark, d))), "sentiment")


#: Names with aliases, and events as rows of zero to three mentions and a label's word.
_PEOPLE = tuple(M.Name(f"User {i}", (f"u{i}", f"nick{i}")) for i in range(12))
_RESOLVE = """
attr AS (
  SELECT event_id, event_id % 4 AS m, event_id % 12 AS a, CASE event_type WHEN 'error' THEN 'error' ELSE 'neu' END AS sentiment,
    CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'User ' || (event_id % 12) WHEN 3 THEN 'NICK' || (event_id % 12) WHEN 4 THEN 'user ' || (event_id % 12) WHEN 5 THEN 'somebody' ELSE 'User 99' END AS label_entity
  FROM events),
res AS (
  SELECT event_id, m, sentiment, label_entity, CASE
      WHEN m = 1 THEN CASE WHEN a = 11 THEN 'Stranger' ELSE 'User ' || a END
      WHEN m >= 2 AND event_id % 7 IN (2, 3, 4) THEN 'User ' || (event_id % 12) END AS entity FROM attr)"""


def _attributed(spark, d):
    i, k = F.col("event_id"), F.col("event_id") % 12
    num = k.cast("string")
    first = F.when(k == 11, "Stranger").when(k % 2 == 0, F.concat(F.lit("U"), num)).otherwise(F.concat(F.lit("User "), num))
    second = F.concat(F.lit("User "), ((i + 5) % 12).cast("string"))
    m = i % 4
    mentioned = F.when(m == 0, F.array().cast("array<string>")).when(m == 1, F.array(first)).when(m == 2, F.array(first, second)).otherwise(F.array(second, first, second))
    w = i % 7
    label = (
        F.when(w == 0, None)
        .when(w == 1, "")
        .when(w == 2, F.concat(F.lit("User "), num))
        .when(w == 3, F.concat(F.lit("NICK"), num))
        .when(w == 4, F.concat(F.lit("user "), num))
        .when(w == 5, "somebody")
        .otherwise("User 99")
    )
    rows = table(spark, d, "events").select(i, mentioned.alias("mentions"), F.when(F.col("event_type") == "error", "error").otherwise("neu").alias("sentiment"), label.alias("label_entity"))
    return M.resolve_entity(rows, M.alias_table(spark, _PEOPLE))


@query("resolve_entity", f"WITH {_RESOLVE} SELECT event_id, entity FROM res")
def _(spark, d):
    return _attributed(spark, d).select("event_id", "entity")


@query(
    "attribution_breakdown",
    f"""WITH {_RESOLVE}, k AS (SELECT CASE WHEN m = 1 THEN 'single' WHEN m >= 2 AND entity IS NOT NULL THEN 'resolved' WHEN m >= 2 AND label_entity IS NULL THEN 'no_label' WHEN m >= 2 THEN 'unresolved' ELSE 'no_mention' END AS class FROM res WHERE sentiment <> 'error')
SELECT class, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM k GROUP BY class""",
)
def _(spark, d):
    return metrics.attribution_classes(_attributed(spark, d))


@query("token_cost", f"{_PARSED} SELECT count(*) AS requests, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, sum(input_tokens) / 1e6 * 0.5 + sum(output_tokens) / 1e6 * 2.5 AS cost FROM labels")
def _(spark, d):
    return L.totals(L.labels_of(results(spark, d)))


@query(
    "cost_scenarios",
    "WITH s(scenario, prompt, answer) AS (VALUES ('short', 40, 20), ('long', 180, 110)), c AS (SELECT count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents) SELECT scenario, n, chars / 4 + n * prompt AS tokens_in, (chars / 4 + n * prompt) / 1e6 * 0.5 + n * answer / 1e6 * 2.5 AS cost FROM c, s",
)
def _(spark, d):
    s = spark.createDataFrame([("short", 40, 20), ("long", 180, 110)], "scenario string, prompt int, answer int")
    c = table(spark, d, "documents").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
    tokens = tokens_of_chars(F.col("chars"), F.col("n") * F.col("prompt"))
    return c.crossJoin(F.broadcast(s)).select("scenario", "n", tokens.alias("tokens_in"), token_cost(tokens, F.col("n") * F.col("answer")).alias("cost"))


@query(
    "model_comparison",
    """WITH r AS (SELECT CASE event_id % 3 WHEN 0 THEN 'small' WHEN 1 THEN 'medium' ELSE 'large' END AS model, event_id % 10 < 6 + event_id % 3 AS correct, 100 + event_id % 50 AS i, 10 + event_id % 7 AS o FROM events),
p(model, pi, po) AS (VALUES ('small', 0.5::DOUBLE, 2.5::DOUBLE), ('medium', 1.0, 5.0), ('large', 3.0, 15.0)),
a AS (SELECT model, round(count(*) FILTER (correct) / count(*), 4) AS accuracy, avg(i) AS mean_in, avg(o) AS mean_out FROM r GROUP BY model),
c AS (SELECT a.*, (mean_in * pi + mean_out * po) * 1000000 / 1e6 AS cost FROM a JOIN p USING (model))
SELECT c.model, accuracy, mean_in, mean_out, cost, round(100 * ((SELECT cost FROM c WHERE model = 'large') - cost) / (SELECT cost FROM c WHERE model = 'large'), 2) AS saving_pct FROM c""",
)
def _(spark, d):
    i = F.col("event_id")
    rows = table(spark, d, "events").select(
        F.when(i % 3 == 0, "small").when(i % 3 == 1, "medium").otherwise("large").alias("model"),
        (i % 10 < 6 + i % 3).alias("correct"),
        (100 + i % 50).alias("input_tokens"),
        (10 + i % 7).alias("output_tokens"),
    )
    prices = spark.createDataFrame([("small", 0.5, 2.5), ("medium", 1.0, 5.0), ("large", 3.0, 15.0)], "model string, price_in double, price_out double")
    return L.model_comparison(rows, prices, 1_000_000, "large")


@query(
    "accuracy_by_class",
    "WITH p AS (SELECT quality AS expected, CASE WHEN n_chars >= 600 THEN 1 ELSE 0 END AS predicted FROM labels JOIN documents USING (doc_id)) SELECT expected, count(*) AS n, count(*) FILTER (predicted = expected) AS hits, round(count(*) FILTER (predicted = expected) / count(*), 4) AS recall FROM p GROUP BY expected",
)
def _(spark, d):
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return L.accuracy(rows.withColumn("predicted", (F.col("n_chars") >= 600).cast("int")), "predicted", "quality")


#: A lexicon of words that the texts hold: word, role, weight.  Weights add up without rounding.
_LEXICON = [
    ("idiot", "word", -1.0), ("und", "word", 0.25), ("que", "word", -0.25), ("eau", "word", 0.5), ("is", "word", -0.5), ("do", "word", 0.75), ("kend", "word", 0.5),
    ("de", "negator", None), ("der", "negator", None), ("not", "negator", None), ("la", "booster", 0.5), ("die", "booster", 0.25), ("the", "booster", -0.25),
]
_LEXICON_SQL = "lex(word, role, weight) AS (VALUES " + ", ".join(f"('{w}', '{r}', {'NULL' if v is None else v}::DOUBLE)" for w, r, v in _LEXICON) + ")"


@query(
    "lexicon_label",
    rf"""WITH {_LEXICON_SQL},
t AS (SELECT doc_id, text, text = upper(text) AS shouted, regexp_extract_all(text, '[\p{{L}}\p{{N}}'']+') AS ws FROM documents),
w AS (SELECT doc_id, shouted, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM t),
j AS (SELECT w.*, lex.role, lex.weight FROM w LEFT JOIN lex ON lex.word = lower(w.word)),
b AS (SELECT *, count(*) FILTER (role = 'negator') OVER before AS negators, max(pos) FILTER (role = 'booster') OVER before AS boosted, arg_max(weight, pos) FILTER (role = 'booster') OVER before AS boost
  FROM j WINDOW before AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)),
v AS (SELECT doc_id, CASE WHEN negators > 0 THEN -0.5 ELSE 1 END * (weight + sign(weight) * (coalesce(boost * power(0.5, pos - boosted - 1), 0)
  + CASE WHEN NOT shouted AND length(word) > 1 AND word <> lower(word) AND word = upper(word) THEN 0.25 ELSE 0 END)) AS v FROM b WHERE role = 'word'),
s AS (SELECT doc_id, sum(v) AS v FROM v GROUP BY doc_id),
c AS (SELECT doc_id, coalesce(v, 0) + coalesce(sign(v), 0) * 0.25 * least(3, length(text) - length(replace(text, '!', ''))) AS total FROM t LEFT JOIN s USING (doc_id)),
o AS (SELECT doc_id, CAST(total / sqrt(total * total + 15) AS DOUBLE) AS compound FROM c)
SELECT doc_id, compound, CASE WHEN compound > 0.05 THEN 'pos' WHEN compound < -0.05 THEN 'neg' ELSE 'neu' END AS label FROM o""",
)
def _(spark, d):
    lexicon = P.Lexicon.of_table(spark.createDataFrame(_LEXICON, "word string, role string, weight double"))
    scored = table(spark, d, "documents").select("doc_id", P.polarity(F.col("text"), lexicon).alias("compound"))
    return scored.withColumn("label", P.lexicon_label(F.col("compound")))


@query("format_strings", "SELECT event_id, printf('%.1f%%', (event_id % 16) / 16.0::DOUBLE * 100) AS pct, printf('%+.3f', (event_id % 17 - 8) / 8.0::DOUBLE) AS signed FROM events")
def _(spark, d):
    i = F.col("event_id")
    return table(spark, d, "events").select("event_id", percent_text((i % 16) / 16.0).alias("pct"), signed_text((i % 17 - 8) / F.lit(8.0)).alias("signed"))


@query(
    "human_units",
    "WITH x AS (SELECT event_id, event_id * 7 AS s, event_id * 1000003 AS b FROM events) SELECT event_id, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE (s // 3600) || 'h ' || (s % 3600 // 60) || 'm ' || (s % 60) || 's' END AS took, CASE WHEN b < 1024 THEN printf('%.1f B', b::DOUBLE) WHEN b < 1048576 THEN printf('%.1f KB', b / 1024.0::DOUBLE) WHEN b < 1073741824 THEN printf('%.1f MB', b / 1048576.0::DOUBLE) WHEN b < 1099511627776 THEN printf('%.1f GB', b / 1073741824.0::DOUBLE) ELSE printf('%.1f TB', b / 1099511627776.0::DOUBLE) END AS size FROM x",
)
def _(spark, d):
    return table(spark, d, "events").select("event_id", duration_text(F.col("event_id") * 7).alias("took"), size_text(F.col("event_id") * 1000003).alias("size"))


@query("batch_number", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id AS INTEGER) END AS batch_num FROM events")
def _(spark, d):
    name = F.when(F.col("event_id") % 5 == 0, "notes.txt").otherwise(F.format_string("batch_%03d.jsonl", F.col("event_id")))
    return table(spark, d, "events").select("event_id", batch_number(name).alias("batch_num"))


@query(
    "validate_requests",
    """WITH f AS (SELECT 'batch_' || (event_id % 9) AS file, event_id AS line, CASE WHEN event_id % 9 < 6 OR event_id < 100 THEN NULL WHEN event_id % 9 = 6 THEN 'invalid JSON' WHEN event_id % 9 = 7 THEN 'missing custom_id' ELSE 'missing params' END AS wrong FROM events)
SELECT file, count(*) AS rows, min(line) FILTER (wrong IS NOT NULL) AS bad_line, arg_min(wrong, line) FILTER (wrong IS NOT NULL) AS error, count(wrong) = 0 AS valid FROM f GROUP BY file""",
)
def _(spark, d):
    i = F.col("event_id")
    k = i % 9
    good = F.format_string('{"custom_id": "%d", "params": {}}', i)
    line = F.when((k < 6) | (i < 100), good).when(k == 6, "{broken").when(k == 7, '{"params": {}}').otherwise(F.format_string('{"custom_id": "%d"}', i))
    return L.validated(table(spark, d, "events").select(line.alias("value"), i.alias("line"), F.concat(F.lit("batch_"), k.cast("string")).alias("file")))


#: Orders as batches of a state, and lineitem's orders as request files.
_STATE = "st AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'ended' WHEN 'O' THEN 'in_progress' END AS status, o_orderkey % 2 = 0 AS results_downloaded FROM orders)"


@query(
    "batch_state_views",
    f"WITH {_STATE} SELECT 'pending' AS view, count(*) AS n FROM st WHERE status IS DISTINCT FROM 'ended' UNION ALL SELECT 'downloadable', count(*) FROM st WHERE status = 'ended' AND NOT results_downloaded UNION ALL SELECT 'to_submit', (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0))",
)
def _(spark, d):
    o = table(spark, d, "orders")
    st = o.select(
        F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("request_file"),
        F.when(F.col("o_orderstatus") == "F", "ended").when(F.col("o_orderstatus") == "O", "in_progress").alias("status"),
        (F.col("o_orderkey") % 2 == 0).alias("results_downloaded"),
    )
    files = table(spark, d, "lineitem").select(F.concat(F.lit("f"), F.col("l_orderkey").cast("string")).alias("request_file")).distinct()
    found = {"pending": pending(st), "downloadable": downloadable(st), "to_submit": to_submit(files, st.where("results_downloaded"))}
    out = None
    for name, df in found.items():
        one = df.agg(F.lit(name).alias("view"), F.count("*").alias("n"))
        out = one if out is None else out.union(one)
    return out
