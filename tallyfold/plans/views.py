"""Metric views, series and leaderboards over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.dates import date_of_epoch, week_of
from tallyfold.operators import metrics, ranking, temporal
from tallyfold.plans.adapters import CLASSIFIED, METRICS, TEAMS, classified, teams
from tallyfold.plans.registry import query, table

_W = f"WITH {CLASSIFIED}"
_GOOD = "FROM classified WHERE sentiment <> 'error'"
_ENTITY = f"{_W}, e AS (SELECT entity, {METRICS} {_GOOD} GROUP BY entity)"
_WEEKLY = f"{_W}, w AS (SELECT entity, week, {METRICS} {_GOOD} GROUP BY entity, week)"
_TEAM = f"{_W}, t AS (SELECT entity, team, {METRICS} {_GOOD} AND team IS NOT NULL GROUP BY entity, team)"
_CUM = f"""{_WEEKLY}, k AS (SELECT * FROM w WHERE week <> (SELECT max(week) FROM w)),
g AS (SELECT entity, week FROM (SELECT DISTINCT entity FROM k), (SELECT DISTINCT week FROM k)),
f AS (SELECT g.entity, g.week, coalesce(neg_count, 0) AS n, coalesce(comment_count, 0) AS c FROM g LEFT JOIN k USING (entity, week)),
r AS (SELECT entity, week, CAST(sum(n) OVER o AS BIGINT) AS cum_neg, CAST(sum(c) OVER o AS BIGINT) AS cum_total FROM f WINDOW o AS (PARTITION BY entity ORDER BY week ROWS UNBOUNDED PRECEDING)),
cum AS (SELECT *, round(cum_neg / nullif(cum_total, 0), 4) AS cum_neg_rate FROM r)"""
_LEAD = "lead AS (SELECT entity FROM cum WHERE week = (SELECT max(week) FROM cum) AND cum_total >= 20 ORDER BY cum_neg_rate DESC, entity LIMIT 10)"
_WEEKS = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22"]


@query("metrics_by_entity", f"{_ENTITY} SELECT * FROM e")
def _(spark, d):
    return metrics.by_entity(classified(spark, d)).orderBy(F.desc("neg_rate"), "entity")


@query("metrics_entity_week", f"{_WEEKLY} SELECT * FROM w")
def _(spark, d):
    return metrics.by_entity_week(classified(spark, d))


@query("metrics_entity_team", f"{_TEAM} SELECT * FROM t")
def _(spark, d):
    return metrics.by_entity_team(classified(spark, d))


@query("metrics_team_enriched", f"{_W}, {TEAMS}, m AS (SELECT team, {METRICS} {_GOOD} AND team IS NOT NULL GROUP BY team) SELECT m.*, conference FROM m LEFT JOIN teams USING (team)")
def _(spark, d):
    return metrics.by_team(classified(spark, d), teams(spark, d))


@query(
    "metrics_all_views",
    f"""{_W} SELECT 'entity' AS view, entity, NULL::DATE AS week, NULL AS team, {METRICS} {_GOOD} GROUP BY entity
UNION ALL SELECT 'entity_week', entity, week, NULL, {METRICS} {_GOOD} GROUP BY entity, week
UNION ALL SELECT 'entity_team', entity, NULL, team, {METRICS} {_GOOD} AND team IS NOT NULL GROUP BY entity, team
UNION ALL SELECT 'team', NULL, NULL, team, {METRICS} {_GOOD} AND team IS NOT NULL GROUP BY team""",
)
def _(spark, d):
    return metrics.all_views(classified(spark, d))


@query("metrics_entity_enriched", f"{_ENTITY}, dim AS (SELECT 'user ' || c_custkey AS entity, c_mktsegment AS team FROM customer) SELECT e.*, team FROM e LEFT JOIN dim USING (entity)")
def _(spark, d):
    dim = table(spark, d, "customer").select(F.concat(F.lit("user "), F.col("c_custkey").cast("string")).alias("entity"), F.col("c_mktsegment").alias("team"))
    return metrics.enriched(metrics.by_entity(classified(spark, d)), dim, "entity", ["team", "conference", "image"])


@query("entity_dim_filtered", f"{_W} SELECT 'user ' || c_custkey AS entity, c_name, n_name AS home FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE 'user ' || c_custkey IN (SELECT entity {_GOOD})")
def _(spark, d):
    nation = table(spark, d, "nation")
    dim = table(spark, d, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    dim = dim.select(F.concat(F.lit("user "), F.col("c_custkey").cast("string")).alias("entity"), "c_name", F.col("n_name").alias("home"))
    return metrics.seen_only(dim, metrics.usable(classified(spark, d)), "entity")


@query(
    "run_metadata",
    f"""{_W} SELECT count(*) AS total_comments, count(*) FILTER (sentiment <> 'error') AS usable_comments, count(*) FILTER (sentiment <> 'error' AND entity IS NOT NULL) AS attributed_comments,
count(DISTINCT entity) FILTER (sentiment <> 'error') AS entity_count, count(DISTINCT team) FILTER (sentiment <> 'error') AS team_count, count(DISTINCT week) FILTER (sentiment <> 'error') AS week_count,
count(*) FILTER (sentiment = 'error') AS excluded_comments FROM classified""",
)
def _(spark, d):
    return metrics.run_metadata(classified(spark, d))


@query("sanity_checks", "SELECT * FROM (VALUES ('funnel', true), ('attributed', true), ('weekly', true), ('labels', true), ('net', true)) AS t(\"check\", ok)")
def _(spark, d):
    return metrics.sanity_checks(classified(spark, d))


@query("threshold_filter", f"{_ENTITY} SELECT * FROM e WHERE comment_count >= 60")
def _(spark, d):
    return ranking.at_least(metrics.by_entity(classified(spark, d)), 60)


@query("threshold_sweep", f"{_ENTITY}, l AS (SELECT unnest([20, 40, 60, 80]) AS least) SELECT least, count(*) FILTER (comment_count >= least) AS entities, CAST(coalesce(sum(comment_count) FILTER (comment_count >= least), 0) AS BIGINT) AS comments FROM e, l GROUP BY least")
def _(spark, d):
    return ranking.threshold_sweep(metrics.by_entity(classified(spark, d)), [20, 40, 60, 80])


def _board(name: str, metric: str, order: str, least: int, ascending: bool | None = None):
    sql = f"{_ENTITY} SELECT *, CAST(row_number() OVER (ORDER BY {metric} {order}, entity) AS INTEGER) AS rank FROM e WHERE comment_count >= {least} ORDER BY {metric} {order}, entity LIMIT 10"

    @query(f"leaderboard_{name}", sql)
    def _(spark, d):
        return ranking.leaderboard(metrics.by_entity(classified(spark, d)), metric, 10, least, ascending)


_board("neg", "neg_rate", "DESC", 40)
_board("pos", "pos_rate", "DESC", 40)
_board("net", "net_sentiment", "ASC", 50)
_board("loved", "net_sentiment", "DESC", 50, ascending=False)
_board("polarizing", "polarization", "DESC", 30)
_board("neg_volume", "neg_count", "DESC", 0)


@query("entity_rank", f"{_ENTITY} SELECT entity, neg_rate, CAST(row_number() OVER (ORDER BY neg_rate DESC, entity) AS INTEGER) AS rank FROM e")
def _(spark, d):
    return ranking.ranked(metrics.by_entity(classified(spark, d)), "neg_rate").select("entity", "neg_rate", "rank")


def _extreme(name: str, order: str):
    sql = f"{_TEAM}, p AS (SELECT team, entity, neg_rate, comment_count, CAST(row_number() OVER (PARTITION BY team ORDER BY neg_rate {order}, entity) AS INTEGER) AS place FROM t WHERE comment_count >= 2) SELECT * FROM p WHERE place = 1"

    @query(name, sql)
    def _(spark, d):
        rows = ranking.at_least(metrics.by_entity_team(classified(spark, d)), 2).select("team", "entity", "neg_rate", "comment_count")
        return ranking.first_of_group(rows, "team", [F.desc("neg_rate") if order == "DESC" else F.asc("neg_rate"), F.asc("entity")])


_extreme("team_top_negative", "DESC")
_extreme("team_top_positive", "ASC")


@query(
    "entity_hostile_friendly",
    f"""{_W}, t AS (SELECT team AS entity, CAST(user_id % 7 AS BIGINT) AS rival, {METRICS} {_GOOD} AND team IS NOT NULL GROUP BY 1, 2),
p AS (SELECT entity, rival, neg_rate, CAST(row_number() OVER (PARTITION BY entity ORDER BY neg_rate DESC, rival) AS INTEGER) AS hi, CAST(row_number() OVER (PARTITION BY entity ORDER BY neg_rate, rival) AS INTEGER) AS lo FROM t)
SELECT entity, rival, neg_rate, hi AS place, 'hostile' AS side FROM p WHERE hi <= 2 UNION ALL SELECT entity, rival, neg_rate, lo, 'friendly' FROM p WHERE lo <= 2""",
)
def _(spark, d):
    rows = classified(spark, d).where("team IS NOT NULL").select("sentiment", F.col("team").alias("entity"), (F.col("user_id") % 7).alias("rival"))
    return ranking.both_ends(metrics.compute_metrics(metrics.usable(rows), ["entity", "rival"]).select("entity", "rival", "neg_rate"), "entity", "neg_rate", "rival", 2)


def _cumulative(spark, d):
    return temporal.cumulative_metrics(metrics.by_entity_week(classified(spark, d)))


@query("cumulative_rate", f"{_CUM} SELECT * FROM cum")
def _(spark, d):
    return _cumulative(spark, d)


@query("masked_rate", f"{_CUM} SELECT entity, week, cum_neg, cum_total, CASE WHEN cum_total >= 15 THEN cum_neg_rate END AS cum_neg_rate FROM cum")
def _(spark, d):
    return temporal.mask_below(_cumulative(spark, d), 15)


@query("bar_race_long", f"{_CUM}, {_LEAD} SELECT entity, week, cum_neg, cum_total, CASE WHEN cum_total >= 10 THEN cum_neg_rate END AS cum_neg_rate FROM cum WHERE entity IN (SELECT entity FROM lead)")
def _(spark, d):
    return temporal.race_long(_cumulative(spark, d), 10, 20, 10)


@query(
    "bar_race_wide",
    f"{_CUM}, {_LEAD}, {TEAMS}, dim AS (SELECT 'user ' || c_custkey AS entity, c_mktsegment AS team FROM customer WHERE c_custkey % 2 = 0) SELECT cum.entity AS \"Label\", coalesce(any_value(team), '') AS \"Category\", '' AS \"Image\", "
    + ", ".join(f"max(round(CASE WHEN cum_total >= 10 AND week = DATE '{w}' THEN cum_neg_rate END * 100, 2)) AS \"{w}\"" for w in _WEEKS)
    + " FROM cum LEFT JOIN dim ON dim.entity = cum.entity WHERE cum.entity IN (SELECT entity FROM lead) GROUP BY cum.entity",
)
def _(spark, d):
    dim = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("user "), F.col("c_custkey").cast("string")).alias("entity"), F.col("c_mktsegment").alias("team"), F.lit(None).cast("string").alias("image"))
    return temporal.race_wide(_cumulative(spark, d), dim, _WEEKS, 10, 20, 10)


@query("checkpoint_rank", f"{_CUM} SELECT week, entity, cum_neg_rate, CAST(row_number() OVER (PARTITION BY week ORDER BY cum_neg_rate DESC NULLS LAST, entity) AS INTEGER) AS rank FROM cum WHERE week IN (DATE '2024-01-08', DATE '2024-01-22')")
def _(spark, d):
    return temporal.checkpoint_rank(_cumulative(spark, d), ["2024-01-08", "2024-01-22"])


_ROLL = f"{_WEEKLY}, u AS (SELECT week, CAST(sum(comment_count) AS BIGINT) AS comment_count, CAST(sum(neg_count) AS BIGINT) AS neg_count, CAST(sum(pos_count) AS BIGINT) AS pos_count, count(DISTINCT entity) AS entities, round(sum(neg_count) / sum(comment_count), 4) AS neg_rate FROM w GROUP BY week)"


@query("weekly_rollup", f"{_ROLL} SELECT * FROM u")
def _(spark, d):
    return temporal.weekly_rollup(metrics.by_entity_week(classified(spark, d)))


@query("low_weeks", f"{_ROLL}, m AS (SELECT median(comment_count) AS median_count FROM u) SELECT week, comment_count, median_count, comment_count < 0.6 * median_count AS low FROM u, m")
def _(spark, d):
    return temporal.low_weeks(temporal.weekly_rollup(metrics.by_entity_week(classified(spark, d))), 0.6)


@query("rolling7", f"{_W}, s AS (SELECT day, count(*) AS n FROM classified GROUP BY day) SELECT day, n, CASE WHEN count(*) OVER o = 7 THEN avg(n) OVER o END AS rolling FROM s WINDOW o AS (ORDER BY day ROWS 6 PRECEDING)")
def _(spark, d):
    return temporal.rolling_mean(classified(spark, d).groupBy("day").agg(F.count("*").alias("n")), "day", "n")


@query("date_gaps", "WITH s AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) SELECT CAST(unnest(generate_series((SELECT min(day) FROM s), (SELECT max(day) FROM s), INTERVAL 1 DAY)) AS DATE) AS day EXCEPT SELECT day FROM s")
def _(spark, d):
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    return temporal.date_gaps(days, "day")


@query("running_totals", f"{_W}, s AS (SELECT entity, day, count(*) AS n FROM classified GROUP BY entity, day) SELECT entity, day, n, CAST(sum(n) OVER (PARTITION BY entity ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM s")
def _(spark, d):
    return temporal.running(classified(spark, d).groupBy("entity", "day").agg(F.count("*").alias("n")), "entity", ["day"], "n", "upto")


@query("median_quadrants", f"{_ENTITY}, m AS (SELECT median(comment_count) AS mx, median(neg_rate) AS my FROM e) SELECT entity, comment_count, neg_rate, CASE WHEN comment_count >= mx THEN 'high' ELSE 'low' END || '_' || CASE WHEN neg_rate >= my THEN 'high' ELSE 'low' END AS quadrant FROM e, m")
def _(spark, d):
    return ranking.quadrants(metrics.by_entity(classified(spark, d)).select("entity", "comment_count", "neg_rate"), "comment_count", "neg_rate")


@query("week_of_epoch", "SELECT event_id, CAST(ts AS DATE) AS day, CAST(date_trunc('week', ts) AS DATE) AS week, CAST(isodow(ts) AS INTEGER) AS weekday FROM events")
def _(spark, d):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    day = date_of_epoch(F.unix_date(F.to_date("ts")).cast("long") * 86400 + seconds % 86400)
    return table(spark, d, "events").select("event_id", day.alias("day"), week_of(day).alias("week"), (F.weekday(day) + 1).alias("weekday"))
