import random
import time

import pytest
import regex
from pyspark.sql import functions as F

from tallyfold.operators import matching as M
from tallyfold.operators.records import Step, Steps, extract_fields, from_source, has_valid_body

NAMES = (M.Name("Anthony D", ("ad", "anthony d")), M.Name("Ja M", ("ja", "morant")), M.Name("Stephen C", ("steph", "curry")), M.Name("Nikola J", ("jokic", "jokić")))
SHORT = frozenset({"ad", "ja"})


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("AD was great", ["Anthony D"]),
        ("(AD) was", ["Anthony D"]),
        ("an advertisement", []),
        ("ad_x", []),
        ("java and ja!", ["Ja M"]),
        ("Morant, curry and AD", ["Anthony D", "Ja M", "Stephen C"]),
        ("curry curry STEPH", ["Stephen C"]),
        ("JOKIĆ", ["Nikola J"]),
        ("éad", []),
        ("", []),
        (None, []),
    ],
)
def test_mentions(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(M.mentions(F.col("t"), NAMES, SHORT)).first()[0] == expected


def test_strict_matcher_removes(spark):
    df = spark.createDataFrame([("ad and curry",)], "t string")
    assert df.select(M.mentions(F.col("t"), NAMES, SHORT, frozenset({"curry"}))).first()[0] == ["Anthony D"]


@pytest.mark.parametrize(
    ("mentions", "label", "expected"),
    [
        (["Stephen C"], "Ja M", "Stephen C"),
        (["jokic"], None, "Nikola J"),
        (["Nobody"], None, "Nobody"),
        (["Ja M", "Stephen C"], "Stephen C", "Stephen C"),
        (["Ja M", "Stephen C"], "Nikola J", "Nikola J"),
        (["Ja M", "Stephen C"], "CURRY", "Stephen C"),
        (["Ja M", "Stephen C"], "stephen c", "Stephen C"),
        (["Ja M", "Stephen C"], None, None),
        (["Ja M", "Stephen C"], "", None),
        (["Ja M", "Stephen C"], "who", None),
        ([], "Ja M", None),
        (None, "Ja M", None),
    ],
)
def test_resolve(spark, mentions, label, expected):
    rows = spark.createDataFrame([(mentions, label)], "mentions array<string>, label_entity string")
    assert M.resolve_entity(rows, M.alias_table(spark, NAMES)).first()["entity"] == expected


TEAMS = (M.Name("Lakers", ("lakers",), ("lal",)), M.Name("Celtics", (), ("bos",)), M.Name("Nets", ("nets",)), M.Name("Hornets", ("hornets",)))


@pytest.mark.parametrize(
    ("tag", "team"), [(":lal-1: Lakers", "Lakers"), (":bos-1:", "Celtics"), ("Celtics", "Celtics"), (None, None), ("", None), ("who", None), (":x: Hornets", "Hornets"), ("NETS", "Nets")]
)
def test_longest_alias(spark, tag, team):
    rows = spark.createDataFrame([(tag, 1)], "tag string, k int")
    got = M.with_longest_alias(rows, "tag", TEAMS).collect()
    assert len(got) == 1 and got[0]["team"] == team


def test_collisions():
    assert M.collisions((M.Name("A", ("x",)), M.Name("B", ("X",)))) == {"x": ["A", "B"]}
    assert not M.collisions(NAMES)


@pytest.mark.parametrize(("body", "ok"), [("hi", True), ("[deleted]", False), ("[removed]", False), ("", False), (None, False), (" [deleted]", True), ("[DELETED]", True)])
def test_body(spark, body, ok):
    assert spark.createDataFrame([(body,)], "body string").select(has_valid_body()).first()[0] is ok


def test_steps_credit_the_first_failure(spark):
    rows = spark.createDataFrame([("nba", "x"), ("NBA", ""), ("other", ""), (None, "y")], "subreddit string, body string")
    steps = Steps(Step("source", from_source(["nba"])), Step("body", has_valid_body()))
    assert steps.stats(rows).first().asDict() == {"total": 4, "accepted": 1, "rejected_source": 2, "rejected_body": 1}
    assert steps.accepted(rows).count() == 1
    from pyspark.sql import Observation

    seen = Observation()
    assert len(steps.accepted(rows, seen).collect()) == 1
    assert seen.get["rejected_source"] == 2 and seen.get["accepted"] == 1


def test_extract_fields(spark):
    got = extract_fields(spark.createDataFrame([("1", 7, "x")], "id string, score int, extra string"))
    assert len(got.columns) == 11 and got.first()["id"] == "1" and got.first()["score"] == 7 and got.first()["body"] is None


def test_unresolved(spark):
    rows = spark.createDataFrame([("Curry",), ("who",), ("who",), ("he",), (None,)], "v string")
    assert [tuple(r) for r in M.unresolved(rows, "v", M.alias_table(spark, NAMES), 5).collect()] == [("who", 2), ("he", 1)]


def test_mentions_equal_a_test_of_each_alias(spark):
    """Random texts and aliases with overlaps, one inside another, shared by names, next to marks and digits."""
    r = random.Random(5)
    alphabet = "abé _-1ß\u0301"
    words = sorted({"".join(r.choice(alphabet) for _ in range(r.randrange(1, 4))).lower() for _ in range(60)})
    names = tuple(M.Name(f"N{k}", tuple(r.sample(words, 3))) for k in range(12))
    short = frozenset(r.sample(words, 30))
    texts = ["".join(r.choice(alphabet + "AB") for _ in range(r.randrange(0, 25))) for _ in range(400)]
    word = r"[\p{Alphabetic}\p{M}\p{Nd}\p{Pc}]"

    def holds(text, alias):
        if alias not in short:
            return alias in text
        ends = [i for i in range(len(text) + 1) if (i > 0 and bool(regex.match(word, text[i - 1]))) != (i < len(text) and bool(regex.match(word, text[i])))]
        return any(text.startswith(alias, i) and i + len(alias) in ends for i in ends)

    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", M.mentions(F.col("t"), names, short).alias("m")).collect()
    assert all(row["m"] == [n.name for n in names if any(holds(row["t"].lower(), a) for a in n.aliases)] for row in got)


def test_thousands_of_aliases_cost_a_text_no_more(spark):
    texts = spark.range(4000).select(F.concat_ws(" ", *[F.format_string("w%d", F.pmod(F.xxhash64("id", F.lit(k)), F.lit(50_000))) for k in range(60)]).alias("t")).cache()
    texts.count()

    def took(n):
        found = texts.select(F.size(M.mentions(F.col("t"), tuple(M.Name(f"N{k}", (f"w{k * 7}x", f"w{k * 7 + 1} ")) for k in range(n)))).alias("n"))
        runs = []
        for _ in range(3):
            began = time.perf_counter()
            found.agg(F.sum("n")).collect()
            runs.append(time.perf_counter() - began)
        return min(runs)

    few, many = took(20), took(2000)
    assert many < 3 * few + 0.5


def test_containment(spark):
    names = spark.createDataFrame([("Ab",), ("ab",), ("",), (None,), ("x",), ("abcd",), ("zzzz",), ("bcdb",)], "name string")
    labels = spark.createDataFrame([("xABy", 2), ("abcdbcd", 3), ("", 5), (None, 7), ("ab", 11), ("X", 13)], "label string, n long")
    got = M.containment(names, labels, "name", "label", "n")
    assert "BroadcastNestedLoopJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("Ab", 3, 16), ("ab", 3, 16), ("", 5, 34), (None, 0, 0), ("x", 2, 15), ("abcd", 1, 3), ("zzzz", 0, 0), ("bcdb", 1, 3)], key=str)


def test_containment_of_names_that_share_their_beginning(spark):
    """All labels and names begin alike; each name meets only labels that hold its own run."""
    names = spark.range(300).select(F.format_string("source %d.", "id").alias("name"))
    labels = spark.range(300).select(F.format_string("my source %d. here", "id").alias("label"), F.lit(1).cast("long").alias("n"))
    assert {tuple(r)[1:] for r in M.containment(names, labels, "name", "label", "n").collect()} == {(1, 1)}
