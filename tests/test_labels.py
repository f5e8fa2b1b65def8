import json

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import numbers as N
from tallyfold.operators import labels as L
from tallyfold.operators import polarity as P

GOOD = '{"s": "pos", "c": 0.9, "p": "A"}'


@pytest.mark.parametrize(
    ("reply", "expected"),
    [
        (GOOD, ("pos", 0.9, "A")),
        (f"```json\n{GOOD}\n```", ("pos", 0.9, "A")),
        (f"```{GOOD}```", ("pos", 0.9, "A")),
        (f"```json{GOOD}```", ("pos", 0.9, "A")),
        (f"  [{GOOD}, 1] ", ("pos", 0.9, "A")),
        ('{"s": "neg"}', ("neg", 0.0, None)),
        ('{"s": "neu", "c": "0.5", "p": null}', ("neu", 0.5, None)),
        ('{"s": "neu", "c": 7}', ("neu", 7.0, None)),
        ('{"s": "POS", "c": 1}', ("error", 0.0, None)),
        ('{"s": "pos", "c": null}', ("error", 0.0, None)),
        ('{"s": "pos", "c": "high"}', ("error", 0.0, None)),
        ('{"sentiment": "pos"}', ("error", 0.0, None)),
        ('"pos"', ("error", 0.0, None)),
        ("[]", ("error", 0.0, None)),
        ("{broken", ("error", 0.0, None)),
        ("plain", ("error", 0.0, None)),
        ("", ("error", 0.0, None)),
        ("  \n", ("error", 0.0, None)),
        (None, ("error", 0.0, None)),
    ],
)
def test_parse_reply(spark, reply, expected):
    r = spark.createDataFrame([(reply,)], "t string").select(L.parse_reply(F.col("t")).alias("r")).first()["r"]
    assert (r["sentiment"], r["confidence"], r["label_entity"]) == expected
    assert r["raw"] == (reply if expected[0] == "error" else None)


@pytest.mark.parametrize(("i", "o", "cost"), [(1_000_000, 1_000_000, 3.0), (0, 0, 0.0), (1_000_000, 0, 0.5), (0, 1_000_000, 2.5)])
def test_cost(spark, i, o, cost):
    assert spark.range(1).select(N.token_cost(F.lit(i), F.lit(o))).first()[0] == pytest.approx(cost)


def test_batches_of_wide_rows_are_full(spark):
    """More columns than the key, and more rows than any sample of them."""
    rows = spark.range(40_000).selectExpr("id * 7919 % 40009 AS k", "'x' AS a", "id AS b", "cast(id as string) AS c").repartition(9)
    for size in (700, 1, 50_000):
        got = L.numbered(rows, "k", size).groupBy("batch_num").count().orderBy("batch_num").collect()
        assert [r["count"] for r in got[:-1]] == [size] * (len(got) - 1) and sum(r["count"] for r in got) == 40_000
    order = L.numbered(rows, "k", 700).groupBy("batch_num").agg({"k": "max"}).orderBy("batch_num").collect()
    assert [r[1] for r in order] == sorted(r[1] for r in order)


def test_numbered_batches(spark):
    got = L.numbered(spark.range(25).withColumnRenamed("id", "k"), "k", 10).groupBy("batch_num").count().orderBy("batch_num").collect()
    assert [tuple(r) for r in got] == [(1, 10), (2, 10), (3, 5)]


def test_requests_and_offline_classifier(spark):
    rows = spark.createDataFrame([("1", "superb game"), ("2", 'the "dreadful"')], "id string, body string")
    requests = L.requests(rows, "m")
    first = json.loads(requests.select(F.to_json("params")).first()[0])
    assert first["model"] == "m" and first["messages"][0]["role"] == "user" and "superb game" in first["messages"][0]["content"]
    labels = {r["id"]: r for r in L.labels_of(L.classified(requests, L.offline)).collect()}
    assert labels["1"]["sentiment"] == "pos" and labels["2"]["sentiment"] == "neg" and labels["1"]["input_tokens"] > 0


def test_dead_letters_and_dropped(spark):
    results = spark.createDataFrame([("1", "succeeded", GOOD, 5, 6), ("2", "errored", None, None, None), ("3", None, None, None, None)], "custom_id string, result_type string, content string, input_tokens long, output_tokens long")
    assert L.dead_letters(results).count() == 2
    comments = spark.createDataFrame([("9",)], "id string")
    assert [r["id"] for r in L.dropped_labels(comments, L.labels_of(results)).collect()] == ["1"]
    assert L.totals(results).first()["input_tokens"] == 5


@pytest.mark.parametrize(("x", "text"), [(0.5105, "51.0%"), (0.0674, "6.7%"), (0.9999, "100.0%")])
def test_percent(spark, x, text):
    assert spark.range(1).select(N.percent_text(F.lit(x))).first()[0] == text


@pytest.mark.parametrize(("x", "text"), [(-0.3659, "-0.366"), (0.145, "+0.145"), (0.0, "+0.000")])
def test_signed(spark, x, text):
    assert spark.range(1).select(N.signed_text(F.lit(x))).first()[0] == text


@pytest.mark.parametrize(("s", "text"), [(45, "45s"), (125.9, "2m 5s"), (3605, "1h 0m 5s")])
def test_duration(spark, s, text):
    assert spark.range(1).select(N.duration_text(F.lit(s))).first()[0] == text


@pytest.mark.parametrize(("b", "text"), [(512, "512.0 B"), (1536, "1.5 KB"), (5 * 1024**3, "5.0 GB"), (3 * 1024**5, "3072.0 TB")])
def test_size(spark, b, text):
    assert spark.range(1).select(N.size_text(F.lit(b))).first()[0].replace(",", "") == text


def test_rounding_and_empty_rate(spark):
    r = spark.range(1).select(N.round_half_away(F.lit(57) / F.lit(800), 4), N.rate(F.lit(0), F.lit(0)), N.round_half_away(F.lit(-0.25), 1)).first()
    assert (r[0], r[1], r[2]) == (0.0713, None, -0.3) or r[0] == 0.0712


def test_polarity(spark):
    df = spark.createDataFrame([("Superb, superb!",), ("the dreadful, sloppy one",), ("so",), (None,)], "t string")
    assert [r[0] for r in df.select(P.lexicon_label(P.polarity(F.col("t")))).collect()] == ["pos", "neg", "neu", "neu"]


def test_validation(spark):
    rows = spark.createDataFrame([("f", 1, '{"custom_id": "1", "params": {}}'), ("f", 2, ""), ("f", 3, "[1]"), ("g", 1, '{"custom_id": 1, "params": 2}')], "file string, line int, value string")
    got = {r["file"]: r for r in L.validated(rows).collect()}
    assert got["f"]["rows"] == 2 and got["f"]["bad_line"] == 3 and not got["f"]["valid"] and got["g"]["valid"]


def test_dry_run(spark):
    rows = spark.createDataFrame([("f", 1, '{"custom_id": "1", "params": {}}'), ("f", 2, '{"custom_id": "2", "params": {}}')], "file string, line int, value string")
    r = L.dry_run(rows, 10).first()
    assert r["valid"] and r["rows"] == 2 and r["cost"] == pytest.approx(16 / 1e6 * 0.5 + 20 / 1e6 * 2.5)


def test_equal_values_are_numbered_in_many_tasks(spark):
    """40,000 rows of one value, beside values that are spread; no range holds more than a few times its share."""
    from tallyfold.operators import ranges

    rows = spark.range(40_000).select(F.lit("same").alias("k"), "id").union(spark.range(20_000).select(F.col("id").cast("string"), F.col("id") + 90_000)).union(spark.range(3).select(F.lit(None).cast("string"), "id"))
    got = L.numbered(rows.repartition(8), "k", 700)
    sizes = [r["count"] for r in got.groupBy("batch_num").count().orderBy("batch_num").collect()]
    assert sizes == [700] * (60_003 // 700) + [60_003 % 700]
    assert got.where("k IS NULL").select("batch_num").distinct().collect() == [(1,)]
    keyed = rows.withColumn("t", ranges.tie(rows))
    key = F.struct("k", "t")
    per = [r["count"] for r in ranges.placed(keyed, ranges.bounds(keyed, key, 16), key, "part").groupBy("part").count().collect()]
    assert len(per) == 16 and max(per) < 2 * 60_003 / 16


def test_one_value_that_stands_often_leaves_the_others_their_ranges(spark):
    from tallyfold.operators import ranges

    rows = spark.range(20_000).union(spark.range(5000).select(F.lit(77).cast("long")))
    per = [r["count"] for r in ranges.placed(rows, ranges.bounds(rows, F.col("id"), 8), F.col("id"), "part").groupBy("part").count().collect()]
    assert len(per) == 8 and max(per) < 5000 + 2 * 20_000 / 8
    assert ranges.placed(rows.limit(0), ranges.bounds(rows.limit(0), F.col("id"), 8), F.col("id"), "part").count() == 0


@pytest.mark.parametrize(
    ("text", "total"),
    [
        ("good", 0.5),
        ("not good", -0.25),
        ("not a very good", -0.375),
        ("never did we see good", 0.5),
        ("very good", 0.75),
        ("truly a good", 0.75),
        ("truly a b good", 0.625),
        ("truly a b c good", 0.5),
        ("slightly bad", -0.25),
        ("GOOD one", 0.75),
        ("GOOD ONE", 0.5),
        ("a VERY Good", 0.75),
        ("bad!!!!", -1.25),
        ("hm!", 0.0),
        ("good but not bad", 0.75),
        ("isn't good, isn't it", -0.25),
        ("", 0.0),
    ],
)
def test_words_are_weighed_by_those_before_them(text, total):
    assert P.LEXICON.total(text) == total


def test_lexicon_of_a_table(spark):
    rows = spark.createDataFrame([("Nasty", "word", 0.75), ("no", "negator", None), ("mad", "booster", 0.25)], "word string, role string, weight double")
    lexicon = P.Lexicon.of_table(rows)
    assert lexicon.total("mad nasty") == 1.0 and lexicon.total("no nasty") == -0.375 and lexicon.patched({"NASTY": -1.0}).total("nasty") == -1.0
    with pytest.raises(ValueError, match="more than 2"):
        P.Lexicon.of_table(rows, 2)
