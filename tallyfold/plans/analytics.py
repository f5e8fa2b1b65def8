"""Descriptions, shares, joins and samples over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.dates import weekday_number
from tallyfold.functions.numbers import rate
from tallyfold.operators import metrics, profile, ranking
from tallyfold.plans.adapters import CLASSIFIED, THREADS, classified, posts, replies
from tallyfold.plans.registry import query, table


@query("value_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def _(spark, d):
    return profile.value_counts(table(spark, d, "orders"), "o_orderpriority").orderBy(F.desc("n"), "o_orderpriority")


@query("pct_of_total", "SELECT o_orderpriority, o_orderstatus, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM orders GROUP BY 1, 2")
def _(spark, d):
    return profile.shares(profile.value_counts(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus"))


@query("group_stats", "SELECT l_returnflag, count(l_quantity) AS n, avg(l_quantity) AS mean, median(l_quantity) AS median, stddev_samp(l_quantity) AS std, min(l_quantity) AS min, max(l_quantity) AS max, sum(l_quantity) AS sum FROM lineitem GROUP BY l_returnflag")
def _(spark, d):
    return profile.group_stats(table(spark, d, "lineitem"), "l_returnflag", "l_quantity")


_Q = [0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


@query("nearest_quantiles", f"WITH v AS (SELECT o_orderpriority, list_sort(list(o_totalprice)) AS xs, count(*) AS n FROM orders GROUP BY 1), q AS (SELECT unnest({_Q})::DOUBLE AS q) SELECT o_orderpriority, q, xs[CAST(round((n - 1) * q) AS BIGINT) + 1] AS value FROM v, q")
def _(spark, d):
    return profile.nearest_quantiles(table(spark, d, "orders"), "o_totalprice", _Q, ["o_orderpriority"])


@query("nearest_quantiles_all", f"WITH v AS (SELECT list_sort(list(n_chars)) AS xs, count(*) AS n FROM documents), q AS (SELECT unnest({_Q})::DOUBLE AS q) SELECT q, xs[CAST(round((n - 1) * q) AS BIGINT) + 1] AS value FROM v, q")
def _(spark, d):
    return profile.nearest_quantiles(table(spark, d, "documents"), "n_chars", _Q)


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, count(*) - count({c}) AS null_count, avg({c}::DOUBLE) AS mean, stddev_samp({c}::DOUBLE) AS std, min({c})::DOUBLE AS min, quantile_cont({c}::DOUBLE, 0.25) AS p25, quantile_cont({c}::DOUBLE, 0.5) AS p50, quantile_cont({c}::DOUBLE, 0.75) AS p75, max({c})::DOUBLE AS max FROM part"
        for c in ("p_size", "p_retailprice")
    ),
)
def _(spark, d):
    return profile.describe(table(spark, d, "part"), ["p_size", "p_retailprice"])


@query(
    "null_profile",
    "WITH j AS (SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l USING (doc_id)) "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, round(100 * (count(*) - count({c})) / count(*), 2) AS pct FROM j" for c in ("doc_id", "lang", "quality", "toxic")),
)
def _(spark, d):
    return profile.completeness(table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left").select("doc_id", "lang", "quality", "toxic"))


@query("explode_counts", "WITH m AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN [] WHEN 1 THEN [event_type] WHEN 2 THEN [event_type, 'extra'] ELSE ['extra'] END AS xs FROM events), x AS (SELECT unnest(CASE WHEN len(xs) = 0 THEN [NULL] ELSE xs END) AS item FROM m) SELECT item, count(*) AS n FROM x GROUP BY item")
def _(spark, d):
    k, t = F.col("event_id") % 4, F.col("event_type")
    xs = F.when(k == 0, F.array().cast("array<string>")).when(k == 1, F.array(t)).when(k == 2, F.array(t, F.lit("extra"))).otherwise(F.array(F.lit("extra")))
    return profile.exploded_counts(table(spark, d, "events").select(xs.alias("xs")), "xs", "item")


@query("error_rate_by_entity", f"WITH {CLASSIFIED}, t AS (SELECT entity, count(*) AS n FROM classified GROUP BY 1), e AS (SELECT entity, count(*) AS k FROM classified WHERE sentiment = 'error' AND user_id % 3 <> 0 GROUP BY 1) SELECT entity, n, coalesce(k, 0) AS errors, round(coalesce(k, 0) / n, 4) AS error_rate FROM t LEFT JOIN e USING (entity)")
def _(spark, d):
    rows = classified(spark, d)
    total = rows.groupBy("entity").agg(F.count("*").alias("n"))
    wrong = rows.where("sentiment = 'error' AND user_id % 3 <> 0").groupBy("entity").agg(F.count("*").alias("errors"))
    return total.join(wrong, "entity", "left").fillna(0, ["errors"]).withColumn("error_rate", rate(F.col("errors"), F.col("n")))


@query("distinct_counts", "SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY event_type")
def _(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.countDistinct(F.to_date("ts")).alias("days"))


@query("distinct_values", "SELECT DISTINCT source, lang FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("source", "lang").distinct()


@query("date_parts_volume", "SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(isodow(o_orderdate) AS INTEGER) AS wd, count(*) AS n FROM orders GROUP BY 1, 2, 3")
def _(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").groupBy(F.year(day).alias("y"), F.month(day).alias("m"), weekday_number(day).alias("wd")).agg(F.count("*").alias("n"))


@query("month_label_pivot", 'SELECT strftime(o_orderdate, \'%Y-%m\') AS month, count(*) FILTER (o_orderstatus = \'F\') AS "F", count(*) FILTER (o_orderstatus = \'O\') AS "O", count(*) FILTER (o_orderstatus = \'P\') AS "P" FROM orders GROUP BY 1')
def _(spark, d):
    return profile.month_pivot(table(spark, d, "orders"), F.date_format("o_orderdate", "yyyy-MM"), "o_orderstatus", ["F", "O", "P"])


@query(
    "histogram50",
    "WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events), b AS (SELECT least(49, CAST(floor((value - lo) * 50 / (hi - lo)) AS INTEGER)) AS bin, count(*) AS n FROM events, e WHERE value IS NOT NULL GROUP BY 1), g AS (SELECT CAST(unnest(range(50)) AS INTEGER) AS bin) SELECT g.bin, lo + g.bin * (hi - lo) / 50 AS lower, coalesce(n, 0) AS n FROM g LEFT JOIN b USING (bin), e",
)
def _(spark, d):
    return profile.histogram(table(spark, d, "events"), "value", 50)


_JOINED = "j AS (SELECT replies.id, body, posts.id AS post, title, link_flair_text FROM replies LEFT JOIN posts ON replace(link_id, 't3_', '') = posts.id)"


def _threaded(spark, d):
    r = replies(spark, d).withColumn("__post", F.replace("link_id", F.lit("t3_"), F.lit("")))
    p = posts(spark, d).withColumnRenamed("id", "post")
    return r.join(p, r["__post"] == p["post"], "left").drop("__post")


@query("post_join_flair", f"WITH {THREADS}, {_JOINED} SELECT link_flair_text, count(*) AS n, count(*) FILTER (contains(lower(body), 'the')) AS hits, round(count(*) FILTER (contains(lower(body), 'the')) / count(*), 4) AS mention_rate FROM j WHERE post IS NOT NULL GROUP BY 1")
def _(spark, d):
    by = _threaded(spark, d).where("post IS NOT NULL").groupBy("link_flair_text").agg(F.count("*").alias("n"), F.count_if(F.lower("body").contains("the")).alias("hits"))
    return by.withColumn("mention_rate", rate(F.col("hits"), F.col("n")))


@query("post_join_failures", f"WITH {THREADS}, {_JOINED} SELECT count(*) AS replies, count(post) AS joined, round(100 * count(post) / count(*), 2) AS pct FROM j")
def _(spark, d):
    return _threaded(spark, d).agg(F.count("*").alias("replies"), F.count("post").alias("joined"), rate(100 * F.count("post"), F.count("*"), 2).alias("pct"))


@query("coverage_2x2", f"WITH {THREADS}, {_JOINED} SELECT contains(lower(body), 'thank') AS in_comment, contains(lower(title), 'the') AS in_title, count(*) AS n FROM j WHERE post IS NOT NULL GROUP BY 1, 2")
def _(spark, d):
    j = _threaded(spark, d).where("post IS NOT NULL")
    return j.groupBy(F.lower("body").contains("thank").alias("in_comment"), F.lower("title").contains("the").alias("in_title")).agg(F.count("*").alias("n"))


@query("name_set_diff", "SELECT c_custkey AS k, 'quiet' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT c_custkey, 'active' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def _(spark, d):
    c, o = table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    return c.join(o, "k", "left_anti").withColumn("side", F.lit("quiet")).union(c.join(o, "k", "left_semi").withColumn("side", F.lit("active")))


@query("share_of_group", "SELECT l_suppkey, sum(l_quantity) AS qty, round(100 * sum(l_quantity) / sum(sum(l_quantity)) OVER (), 4) AS pct FROM lineitem GROUP BY l_suppkey")
def _(spark, d):
    return profile.shares(table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("qty")), "qty", digits=4)


@query("sample_hash", "SELECT doc_id, lang, n_chars FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 50")
def _(spark, d):
    return ranking.sampled(table(spark, d, "documents").select("doc_id", "lang", "n_chars"), 50, "doc_id")


@query("sample_stratified", "SELECT doc_id, lang, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) <= 10")
def _(spark, d):
    return ranking.sampled_by(table(spark, d, "documents").select("doc_id", "lang", "n_chars"), 10, "doc_id", "lang")


@query("metrics_of_unattributed", f"WITH {CLASSIFIED} SELECT team IS NULL AS no_team, sentiment, count(*) AS n FROM classified GROUP BY 1, 2")
def _(spark, d):
    return classified(spark, d).groupBy(F.col("team").isNull().alias("no_team"), "sentiment").agg(F.count("*").alias("n"))


@query("usable_rows", f"WITH {CLASSIFIED} SELECT sentiment, count(*) AS n FROM classified WHERE sentiment <> 'error' GROUP BY 1")
def _(spark, d):
    return metrics.usable(classified(spark, d)).groupBy("sentiment").agg(F.count("*").alias("n"))
