"""The driver's tables in the shapes that the operators take, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.dates import week_of
from tallyfold.operators.matching import Name
from tallyfold.plans.registry import table

#: classified(comment_id, entity, sentiment, team_key, week, day, value): events as labelled comments.
CLASSIFIED = """
classified AS (
  SELECT event_id AS comment_id, 'user ' || user_id AS entity, user_id,
    CASE event_type WHEN 'purchase' THEN 'pos' WHEN 'click' THEN 'neg' WHEN 'error' THEN 'error' ELSE 'neu' END AS sentiment,
    CASE WHEN event_id % 3 <> 0 THEN n_name END AS team,
    CAST(date_trunc('week', ts) AS DATE) AS week, CAST(ts AS DATE) AS day, value
  FROM events LEFT JOIN nation ON n_nationkey = user_id % 25)"""

#: The SQL of metric columns, to be put behind a list of keys and before FROM classified.
METRICS = """
  CAST(count(*) FILTER (sentiment = 'neg') AS BIGINT) AS neg_count, CAST(count(*) FILTER (sentiment = 'pos') AS BIGINT) AS pos_count,
  CAST(count(*) FILTER (sentiment = 'neu') AS BIGINT) AS neu_count, count(*) AS comment_count,
  round(count(*) FILTER (sentiment = 'neg') / count(*), 4) AS neg_rate, round(count(*) FILTER (sentiment = 'pos') / count(*), 4) AS pos_rate,
  round((count(*) FILTER (sentiment = 'pos') - count(*) FILTER (sentiment = 'neg')) / count(*), 4) AS net_sentiment,
  round((count(*) FILTER (sentiment = 'pos') + count(*) FILTER (sentiment = 'neg')) / count(*), 4) AS polarization"""


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    kind = F.when(F.col("event_type") == "purchase", "pos").when(F.col("event_type") == "click", "neg").when(F.col("event_type") == "error", "error").otherwise("neu")
    events = table(spark, sf_dir, "events").withColumn("team_key", (F.col("user_id") % 25).cast("int"))
    return events.join(F.broadcast(nation), F.col("team_key") == F.col("n_nationkey"), "left").select(
        F.col("event_id").alias("comment_id"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("entity"),
        "user_id",
        kind.alias("sentiment"),
        F.when(F.col("event_id") % 3 != 0, F.col("n_name")).alias("team"),
        week_of(F.to_date("ts")).alias("week"),
        F.to_date("ts").alias("day"),
        "value",
    )


#: teams(team, region): the nations as teams.
TEAMS = "teams AS (SELECT n_name AS team, r_name AS conference FROM nation JOIN region ON n_regionkey = r_regionkey)"


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"]).select(F.col("n_name").alias("team"), F.col("r_name").alias("conference"))


#: Names that texts of the documents table mention, in order.  Aliases of up to three letters need word boundaries.
NAMES = (
    Name("Ane", ("anhe", "aner")),
    Name("Bleed", ("blent", "bleea", "edly")),
    Name("Chung", ("chung", "keit")),
    Name("Don", ("de", "do")),
    Name("Eaux", ("eaux", "eau")),
    Name("Is", ("is",)),
    Name("Llar", ("llar", "ñga")),
    Name("Mente", ("mente", "ción")),
    Name("Oueur", ("oueur", "ouch")),
    Name("The", ("thethe", "thing")),
    Name("Und", ("und", "über")),
    Name("Wh", ("whing", "wh")),
)
SHORT = frozenset({"de", "do", "is", "und", "eau", "wh"})
REMOVED = frozenset({"wh", "edly"})
STRICT_SHORT = SHORT | {"keit", "ouch"}

#: Sources as teams: src1 stands in src10 to src19, so the longest alias has to win.
SOURCES = tuple(Name(f"Team {i}", (f"src{i}",)) for i in range(20))

_LETTER = r"[\p{L}\p{M}\p{Nd}\p{Pc}]"


def mention_sql(text: str, names=NAMES, short=SHORT, removed=frozenset()) -> str:
    """The SQL of a text's mentions."""
    each = []
    for n in names:
        tests = []
        for a in n.aliases:
            if a in removed:
                continue
            if a in short:
                tests.append(rf"regexp_matches({text}, '(?i)(^|[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}]){a}($|[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}])')")
            else:
                tests.append(f"contains(lower({text}), '{a}')")
        if tests:
            each.append(f"CASE WHEN {' OR '.join(tests)} THEN '{n.name}' END")
    return f"list_filter([{', '.join(each)}], lambda x: x IS NOT NULL)"


#: threads: turn 0 of a conversation is a post, later turns are comments that link to it.
THREADS = """
posts AS (SELECT CAST(conv_id AS VARCHAR) AS id, text AS title, CASE WHEN conv_id % 4 = 0 THEN NULL ELSE 'flair ' || (conv_id % 4) END AS link_flair_text FROM conversations WHERE turn = 0),
replies AS (SELECT conv_id * 1000 + turn AS id, text AS body, CASE WHEN conv_id % 17 = 0 THEN 't3_x' || conv_id ELSE 't3_' || conv_id END AS link_id FROM conversations WHERE turn > 0)"""


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").where("turn = 0")
    flair = F.when(F.col("conv_id") % 4 != 0, F.concat(F.lit("flair "), (F.col("conv_id") % 4).cast("string")))
    return c.select(F.col("conv_id").cast("string").alias("id"), F.col("text").alias("title"), flair.alias("link_flair_text"))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").where("turn > 0")
    link = F.when(F.col("conv_id") % 17 == 0, F.concat(F.lit("t3_x"), F.col("conv_id").cast("string"))).otherwise(F.concat(F.lit("t3_"), F.col("conv_id").cast("string")))
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("body"), link.alias("link_id"))


#: raw(id, body, subreddit, ...): documents as records, some of them gone, empty or null.
RAW = """
raw AS (
  SELECT doc_id AS id, CASE doc_id % 10 WHEN 3 THEN '[deleted]' WHEN 5 THEN '[removed]' WHEN 7 THEN '' WHEN 9 THEN NULL WHEN 1 THEN ' [deleted]' ELSE text END AS body,
    CASE WHEN doc_id % 6 = 0 THEN NULL WHEN doc_id % 6 = 1 THEN upper(source) ELSE source END AS subreddit, source, lang, n_chars
  FROM documents)"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 10
    body = F.when(k == 3, "[deleted]").when(k == 5, "[removed]").when(k == 7, "").when(k == 9, None).when(k == 1, " [deleted]").otherwise(F.col("text"))
    k = F.col("doc_id") % 6
    sub = F.when(k == 0, None).when(k == 1, F.upper("source")).otherwise(F.col("source"))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), body.alias("body"), sub.alias("subreddit"), "source", "lang", "n_chars")


#: tagged(id, tag): documents with an author's tag in one of several forms.
TAGGED = """
tagged AS (
  SELECT doc_id AS id, CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN ':' || source || '-1: fan' WHEN 2 THEN '[ABC] ' || source WHEN 3 THEN ':bw-' || lang || ': ' || upper(source)
    WHEN 4 THEN upper(source) ELSE 'nobody' END AS tag FROM documents)"""


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("doc_id") % 6, F.col("source")
    tag = (
        F.when(k == 0, None)
        .when(k == 1, F.concat(F.lit(":"), s, F.lit("-1: fan")))
        .when(k == 2, F.concat(F.lit("[ABC] "), s))
        .when(k == 3, F.concat(F.lit(":bw-"), "lang", F.lit(": "), F.upper(s)))
        .when(k == 4, F.upper(s))
        .otherwise("nobody")
    )
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), tag.alias("tag"))


#: results(custom_id, ...): events as a classifier's replies, in the forms that such replies have.
RESULTS = """
results AS (
  SELECT CAST(event_id AS VARCHAR) AS custom_id, CASE WHEN event_id % 11 = 0 THEN 'errored' WHEN event_id % 13 = 0 THEN 'expired' ELSE 'succeeded' END AS result_type,
    event_id % 8 AS form, CASE event_type WHEN 'purchase' THEN 'pos' WHEN 'click' THEN 'neg' ELSE 'neu' END AS s, CAST(event_id % 100 AS DOUBLE) / 100 AS c, 'user ' || user_id AS p,
    100 + event_id % 50 AS input_tokens, 10 + event_id % 7 AS output_tokens
  FROM events)"""


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    kind = F.when(i % 11 == 0, "errored").when(i % 13 == 0, "expired").otherwise("succeeded")
    s = F.when(F.col("event_type") == "purchase", "pos").when(F.col("event_type") == "click", "neg").otherwise("neu")
    c = (i % 100).cast("double") / 100
    obj = F.format_string('{"s": "%s", "c": %s, "p": "user %d"}', s, c.cast("string"), F.col("user_id"))
    form = i % 8
    content = (
        F.when(form == 0, obj)
        .when(form == 1, F.concat(F.lit("```json\n"), obj, F.lit("\n```")))
        .when(form == 2, F.concat(F.lit(" ```"), obj, F.lit("``` \n")))
        .when(form == 3, F.concat(F.lit("["), obj, F.lit("]")))
        .when(form == 4, "[]")
        .when(form == 5, F.replace(obj, F.lit('"s": "'), F.lit('"s": "x')))
        .when(form == 6, "not json")
        .otherwise("  ")
    )
    good = kind == "succeeded"
    return e.select(
        i.cast("string").alias("custom_id"),
        kind.alias("result_type"),
        F.when(good, content).alias("content"),
        F.when(good, 100 + i % 50).alias("input_tokens"),
        F.when(good, 10 + i % 7).alias("output_tokens"),
    )
