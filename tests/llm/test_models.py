import itertools
import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from tallyfold.llm import crf, lm, quality, queries, rules, toxicity


def test_forward_backward_is_exact(monkeypatch):
    monkeypatch.setattr(crf, "STEPS", 3)
    rng = np.random.default_rng(0)
    first = np.array([0, 3, 3, 4, 11])
    s, t, pi = rng.normal(size=11) * 2, rng.normal(size=(2, 2)), rng.normal(size=2)
    got = crf.forward_backward(s, first, t, pi, pairs=True)
    p, pairs = np.zeros(11), np.zeros((2, 2))
    for a, b in zip(first, first[1:], strict=False):
        z, marg, joint = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            w = math.exp((pi[y[0]] if y else 0) + sum(t[u, v] for u, v in zip(y, y[1:], strict=False)) + sum(s[a + k] * v for k, v in enumerate(y)))
            z += w
            marg += w * np.array(y)
            for u, v in zip(y, y[1:], strict=False):
                joint[u, v] += w
        p[a:b] = marg / z
        pairs += joint / z
    assert np.allclose(p, got.p) and np.allclose(pairs, got.pairs)


def labelled(make, n=240):
    rows, toxic, good = [], {}, {}
    for i in range(n):
        w = make(i, 40, 2000).split()
        toxic[i] = int(i % 4 == 0)
        if toxic[i]:
            w[3], w[20], w[30] = "vilelya", ("scumbag", "vilelyo")[i % 8 == 0], "scumbag"
        good[i] = int(i % 3 != 0)
        text = "\n".join(" ".join(w[k : k + 8]) + "." for k in range(0, 40, 8)) if good[i] else "\n".join(" | ".join(w[k : k + 8]) for k in range(0, 40, 8)) + "\n###$$$ @@@"
        rows.append((i, text))
    return rows, toxic, good


def test_toxic_spans(spark, table, make):
    rows, toxic, _ = labelled(make)
    docs = table([*rows, (900, "a vilelyxx é scumbag!"), (901, ""), (902, None), (None, "x"), (903, "so vilelya")])
    labels = spark.createDataFrame([(i, y) for i, y in toxic.items() if i < 200] + [(None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    got = toxicity.tag(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == len(rows) + 5
    by = {r["doc_id"]: r for r in got}
    held = [i for i in toxic if i >= 200]
    assert np.mean([(by[i]["score"] >= 0.5) == toxic[i] for i in held]) >= 0.95
    assert by[901]["score"] == by[902]["score"] < 0.5 and not by[901]["spans"]
    assert [(s["begin"], s["end"]) for s in by[903]["spans"]] == [(3, 10)]
    assert all(0 <= r["score"] <= 1 for r in got)


def test_quality_of_lines(spark, table, make):
    rows, _, good = labelled(make)
    docs = table([*rows, (901, ""), (902, None), (903, "\n \n"), (None, "x")])
    labels = spark.createDataFrame([(i, y) for i, y in good.items() if i < 200], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model, carry=("lang",), marginals=True).collect()
    assert len(got) == len(rows) + 4
    by = {r["doc_id"]: r for r in got}
    held = [i for i in good if i >= 200]
    assert np.mean([(by[i]["score"] >= 0.3) == good[i] for i in held]) >= 0.95
    assert by[901]["score"] == by[902]["score"] == by[903]["score"] and len(by[0]["line_p"]) >= 5


def test_nothing_to_learn(spark, table):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    docs = table([(1, "a b")])
    assert toxicity.tag(docs, toxicity.fit(docs, none)).first()["score"] == 0.5
    assert quality.score(docs, quality.fit(docs, none)).count() == 1
    assert toxicity.tag(table([]), toxicity.fit(table([]), none)).count() == 0


def tokens_of(t):
    return [*(t or "").encode().lower().split(), None]


def test_language_model(spark, table, make):
    from tallyfold.llm.queries import _fold

    rows = [(i, make(i % 9, 80, 12)) for i in range(60)] + [(90, ""), (91, None), (92, "never seen words"), (None, "w1x1 w2x2"), (7, "w3x0 w3x0 w3x0 w3x0"), (7, "w3x0 w3x0")]
    train = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10]
    c = Counter(x for t in train for x in tokens_of(t))
    n, v = sum(c.values()), len(c)
    own = table(rows).withColumn("held_out", _fold(10)).repartition(3)
    for part_bytes in (300, 8 << 20):  # many parts, and few
        got = lm.score(own, ~F.col("held_out"), carry=("held_out", "text"), priors=(2.0, 3.0), part_bytes=part_bytes).collect()
        assert len(got) == len(rows)
        chance, _ = brute_model(train, 2.0, 3.0)
        for r in got:
            w = tokens_of(r["text"])
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(c[x] > 0 for x in w), n)
            assert r["base_score"] == pytest.approx(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), abs=1e-8)
            assert r["score"] == pytest.approx(sum(math.log10(chance(w[max(0, k - 2) : k], x)) for k, x in enumerate(w)), abs=1e-8)


def brute_model(train, two, three):
    """Chances of a word after a history, from plain dictionaries; and the words there are."""
    grams = [Counter(g for t in train for g in zip(*(tokens_of(t)[k:] for k in range(size)), strict=False)) for size in (1, 2, 3)]
    n, v = sum(grams[0].values()), len(grams[0])

    def chance(history, word):
        if not history:
            return (grams[0][(word,)] + 0.1) / (n + 0.1 * (v + 1))
        prior = two if len(history) == 1 else three
        return (grams[len(history)][(*history, word)] + prior * chance(history[1:], word)) / (grams[len(history) - 1][tuple(history)] + prior)

    return chance, [w for (w,) in grams[0]]


def test_a_states_chances_add_up_to_one(make):
    chance, words = brute_model([make(1, 60, 9), make(2, 60, 9), "a b"], 2.0, 3.0)
    for history in ([], [b"a"], [b"unseen"], [words[0], words[1]], [b"unseen", words[2]]):
        assert sum(chance(history, w) for w in [*words, "unknown"]) == pytest.approx(1)


def test_language_model_of_nothing(spark, table):
    got = lm.score(table([(1, "a b")]), False).first()
    assert (got["score"], got["train_tokens"], got["n_known"]) == (0.0, 0, 0)
    assert lm.score(table([])).count() == 0


def test_rules(spark, table, make):
    import re

    rows = [(i, make(i, 30)) for i in range(20)] + [(50, "a b c d e f g h " * 6), (51, "x\nx\n \ny|y\nx"), (52, ""), (53, None), (None, make(3, 40)), (54, "a b c d e f g h i a b c d e f g h i j"), (55, make(55, 60_000, 20_000) + " " + make(55, 500, 20_000))]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in rules.judge(table(rows), labels).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        win = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        c, seen = Counter(win), set()
        cov = {x for k, y in enumerate(win) if c[y] > 1 for x in range(k, k + 8)}
        lines = [x for x in (t or "").split("\n") if x.split()]
        dup = sum(x in seen or seen.add(x) is not None for x in lines)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"]) == (len(w), sum(map(len, w)), len(cov), dup), i
        assert r["base_failed"] == (len(w) < 20 or 100 * len(cov) > 30 * len(w))
        assert not (r["kept"] and r["base_failed"])
    assert rules.judge(table([]), labels).count() == 0


def measured(spark, counts):
    """Rows (n_words, n_symbols), as often as told; ids from 0."""
    rows, k = [], 0
    for words, symbols, times in counts:
        rows += [(k + i, words, 5 * words, symbols, 0, 0) for i in range(times)]
        k += times
    return spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")


def steps(rows, labels, **more):
    return {r["stratum"]: (r["labels"], r["step"]) for r in rules.cutoffs(rows, labels, **more).collect()}


def tail(x, n, risk):
    return math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(risk) + (n - k) * math.log1p(-risk)) for k in range(x + 1))


def test_cutoffs_keep_their_promise(spark):
    """4,000 good documents of one stratum, one in a hundred with a symbol rate of 0.06; words of five characters pass the other rules."""
    rows = measured(spark, [(200, 0, 3960), (200, 60, 40)])
    labels = rows.select("doc_id", F.lit(1).alias("quality"))
    assert steps(rows, labels, risk=0.02)[1] == (4000, 12)  # 1 % may be rejected at a risk of 2 %
    assert steps(rows, labels, risk=0.005)[1] == (4000, 8)  # the last cutoff above 0.06
    few = rows.where("doc_id < 20")
    assert steps(few, labels, risk=0.1)[1] == (20, 0)  # too few to vouch
    most = next(x for x in range(4000) if tail(x, 4000, 0.02) > 0.05 / 4) - 1
    for x in (most, most + 1):
        own = measured(spark, [(200, 0, 4000 - x), (200, 60, x)])
        assert steps(own, labels, risk=0.02)[1][1] == (12 if x == most else 8)


@pytest.mark.parametrize(
    ("counts", "want"),
    [
        ((300, 300, 300, 300), (300, 300, 300, 300)),
        ((300, 300, 300, 10), (300, 300, 310, 310)),
        ((10, 300, 10, 300), (310, 310, 310, 310)),
        ((100, 100, 100, 300), (300, 300, 300, 300)),
        ((5, 5, 5, 5), (20, 20, 20, 20)),
        ((0, 0, 0, 0), (0, 0, 0, 0)),
        ((0, 0, 0, 250), (250, 250, 250, 250)),
    ],
)
def test_strata_are_pooled_until_they_can_vouch(spark, counts, want):
    """A test needs 217 labels at a risk of 2 %."""
    assert rules.least_labels(0.02, 0.05 / 4) == 217
    rows = measured(spark, [(w, 0, n) for w, n in zip((50, 200, 800, 3000), counts, strict=True)])
    got = steps(rows, rows.select("doc_id", F.lit(1).alias("quality")))
    assert tuple(got[s][0] for s in range(4)) == want
    assert all(step == (12 if n >= 217 else 0) for n, step in got.values())


def test_rules_reject_and_spare_on_labels_held_back(spark):
    """Cutoffs from four fifths of the labels, judged on the rest: bad documents go, good ones within the risk."""
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no tables here")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    back = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    judged = rules.judge(docs, labels.where(~back)).join(labels.where(back), "doc_id").where("NOT base_failed").groupBy("quality").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept"))
    got = {r["quality"]: r["kept"] / r["n"] for r in judged.collect()}
    assert got[1] >= 1 - rules.RISK and got[0] < 0.2


def auc(scores, labels):
    """The chance that an example of label 1 scores above one of label 0."""
    order = np.argsort(np.argsort(scores, kind="stable"), kind="stable") + 1.0
    for v in np.unique(scores):
        order[scores == v] = order[scores == v].mean()
    ones = labels == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


@pytest.mark.parametrize(
    ("query", "label", "least_auc", "least_ones", "least_zeros"),
    [("op3_toxicity", "toxic", 0.9, 0.85, 0.99), ("op6_quality", "quality", 0.99, 0.99, 0.9)],
)
def test_worth_on_labels_held_back(spark, query, label, least_auc, least_ones, least_zeros):
    """The queries themselves on whole tables: ranking, and how many of each label are told as such, of documents that taught nothing."""
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no tables here")
    found = queries.QUERIES[query](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("score", "predicted", F.col(label).alias("y")).toPandas()
    y, told = found["y"].to_numpy(), found["predicted"].to_numpy()
    assert len(y) > 500 and auc(found["score"].to_numpy(), y) >= least_auc
    assert (told[y == 1] == 1).mean() >= least_ones and (told[y == 0] == 0).mean() >= least_zeros


def test_contradicting_labels_count_as_good(spark):
    rows = measured(spark, [(200, 0, 300), (200, 600, 300)])
    labels = rows.select("doc_id", F.lit(1).alias("quality")).union(rows.select("doc_id", F.lit(0)))
    assert steps(rows, labels)[1] == (600, 0)
    assert steps(rows, labels.where("quality = 1 AND doc_id < 300"))[1] == (300, 12)


@pytest.mark.parametrize(("n", "x"), [(1, 0), (50, 0), (50, 3), (5000, 60), (100_000, 1900), (10, 10)])
def test_binomial_tail(spark, n, x):
    got = spark.range(1).select(rules.binomial_tail(F.lit(float(x)), F.lit(float(n)), 0.02)).first()[0]
    want = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(0.02) + (n - k) * math.log1p(-0.02)) for k in range(x + 1))
    assert got == pytest.approx(want, rel=1e-7)
