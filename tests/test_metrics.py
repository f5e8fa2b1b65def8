import datetime as dt

from tallyfold.operators import metrics, ranking, temporal

ROWS = [("A", x) for x in ("neg", "neg", "pos", "neu", "neu")] + [("B", x) for x in ("neg", "pos", "pos")]


def test_compute_metrics(spark):
    got = {r["entity"]: r for r in metrics.compute_metrics(spark.createDataFrame(ROWS, "entity string, sentiment string"), ["entity"]).collect()}
    a, b = got["A"], got["B"]
    assert (a["neg_count"], a["pos_count"], a["neu_count"], a["comment_count"]) == (2, 1, 2, 5)
    assert (a["neg_rate"], a["pos_rate"], a["net_sentiment"], a["polarization"]) == (0.4, 0.2, -0.2, 0.6)
    assert (b["neg_count"], b["pos_count"], b["comment_count"], b["neg_rate"], b["pos_rate"]) == (1, 2, 3, 0.3333, 0.6667)


def test_views_agree_with_single_aggregations(spark):
    d = dt.date(2024, 1, 1)
    rows = spark.createDataFrame(
        [("A", "x", d, "neg"), ("A", None, d, "pos"), (None, "x", d, "pos"), ("B", "y", d, "error"), ("B", "y", d, None)], "entity string, team string, week date, sentiment string"
    )
    views = metrics.all_views(rows)
    assert {(r["entity"], r["comment_count"]) for r in views.where("view = 'entity'").collect()} == {("A", 2)}
    assert {(r["team"], r["comment_count"]) for r in views.where("view = 'team'").collect()} == {("x", 2)}
    assert views.where("view = 'entity_team'").count() == metrics.by_entity_team(rows).count() == 1
    assert views.where("view = 'entity_week'").count() == metrics.by_entity_week(rows).count() == 1
    meta = metrics.run_metadata(rows).first()
    assert (meta["total_comments"], meta["usable_comments"], meta["excluded_comments"], meta["attributed_comments"]) == (5, 3, 2, 2)


def test_empty_input(spark):
    none = spark.createDataFrame([], "entity string, team string, week date, sentiment string")
    assert metrics.by_entity(none).count() == 0
    assert metrics.run_metadata(none).first()["total_comments"] == 0


def weekly(spark, *rows):
    return spark.createDataFrame(rows, "entity string, week string, neg_count long, comment_count long")


def test_cumulative_drops_the_last_week(spark):
    w = weekly(spark, ("A", "2024-01-01 00:00:00", 5, 50), ("A", "2024-01-08 00:00:00", 10, 100), ("A", "2024-01-15 00:00:00", 1, 2))
    got = [(r["cum_neg"], r["cum_total"]) for r in temporal.cumulative_metrics(w).orderBy("week").collect()]
    assert got == [(5, 50), (15, 150)]
    assert temporal.cumulative_metrics(w, drop_last_week=False).count() == 3


def test_cumulative_fills_gaps(spark):
    w = weekly(
        spark, ("A", "2024-01-01 00:00:00", 5, 50), ("A", "2024-01-15 00:00:00", 10, 100), ("B", "2024-01-08 00:00:00", 1, 3), ("B", "2024-01-22 00:00:00", 1, 3)
    )
    got = temporal.cumulative_metrics(w).orderBy("entity", "week").collect()
    assert [(r["cum_neg"], r["cum_total"]) for r in got if r["entity"] == "A"] == [(5, 50), (5, 50), (15, 150)]
    assert [r["cum_neg_rate"] for r in got if r["entity"] == "B"] == [None, 0.3333, 0.3333]


def test_mask(spark):
    c = spark.createDataFrame([("A", 500, 0.1), ("A", 1100, 0.2), ("B", 1000, 0.3)], "entity string, cum_total long, cum_neg_rate double")
    assert {(r["cum_total"], r["cum_neg_rate"]) for r in temporal.mask_below(c, 1000).collect()} == {(500, None), (1100, 0.2), (1000, 0.3)}


def test_race_wide(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 8)
    rows = [("A", d1, 100, 1000, 0.1), ("A", d2, 600, 6000, 0.1), ("B", d1, 200, 1000, 0.2), ("B", d2, 1200, 6000, 0.2), ("C", d1, 1, 10, 0.1), ("C", d2, 30, 90, 0.9)]
    c = spark.createDataFrame(rows, "entity string, week date, cum_neg long, cum_total long, cum_neg_rate double")
    dim = spark.createDataFrame([("A", "red", None)], "entity string, team string, image string")
    wide = temporal.race_wide(c, dim, ["2024-01-01", "2024-01-08"], top=2, min_ranking=5000, min_entry=1500)
    assert wide.columns == ["Label", "Category", "Image", "2024-01-01", "2024-01-08"]
    assert {tuple(r) for r in wide.collect()} == {("A", "red", "", None, 10.0), ("B", "", "", None, 20.0)}


def test_ranks(spark):
    rows = spark.createDataFrame([("A", 0.5, 9000), ("B", 0.4, 9000), ("C", 0.3, 6000), ("D", 0.2, 3000), ("E", 0.9, 500)], "entity string, neg_rate double, comment_count long")
    big = ranking.at_least(rows, 5000)
    assert ranking.rank_of(big, "C", "neg_rate") == 3
    assert ranking.rank_of(big, "E", "neg_rate") is None
    assert ranking.rank_of(rows, "A", "neg_rate") == 2
    assert [r["entity"] for r in ranking.leaderboard(rows, "neg_rate", 2, 1000).orderBy("rank").collect()] == ["A", "B"]


def test_ties_go_by_name(spark):
    rows = spark.createDataFrame([("B", 0.5), ("A", 0.5)], "entity string, neg_rate double")
    assert [(r["entity"], r["rank"]) for r in ranking.ranked(rows, "neg_rate").orderBy("rank").collect()] == [("A", 1), ("B", 2)]
    assert ranking.rank_of(rows, "B", "neg_rate") == 2


def test_samples(spark):
    rows = spark.range(500).selectExpr("id", "id % 3 AS k")
    assert ranking.sampled(rows, 20, "id").count() == 20
    one = {r["id"] for r in ranking.sampled_by(rows, 7, "id", "k").collect()}
    assert len(one) == 21 and one == {r["id"] for r in ranking.sampled_by(rows, 7, "id", "k").collect()}
    assert ranking.sampled_by(rows, 1000, "id", "k").count() == 500


def test_rolling_mean_needs_its_rows(spark):
    s = spark.createDataFrame([(k, float(k)) for k in range(9)], "day int, n double")
    got = [r["rolling"] for r in temporal.rolling_mean(s, "day", "n").orderBy("day").collect()]
    assert got == [None] * 6 + [3.0, 4.0, 5.0]
