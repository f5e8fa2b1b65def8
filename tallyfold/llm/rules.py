"""Quality rules whose cutoffs are chosen so that few good documents are rejected, with a stated certainty.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.store import Store

#: The share of good documents of a stratum that all rules together may reject, and the chance that this is exceeded in
#: any stratum.
RISK, DOUBT = 0.02, 0.05
#: Words in a window that counts as repeated if it stands twice in a text.
WINDOW = 8
#: Words from which a text belongs to the next stratum.
STRATA = (100, 400, 1600)
#: Each rule: whether high or low values (of ``rates``) are rejected, and the cutoffs that are tried, the one that
#: rejects least first.  All rules have as many, and take them together, step by step.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("above", (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.075, 0.05, 0.04, 0.03, 0.02)),
    "repeats": ("above", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)),
    "dup_lines": ("above", (20.0, 10.0, 7.0, 5.0, 4.0, 3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.25)),
    "long_words": ("above", (20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.5, 9.0, 8.5, 8.0, 7.5, 7.0)),
    "short_words": ("below", (1.5, 2.0, 2.25, 2.5, 2.75, 3.0, 3.25, 3.5, 3.75, 4.0, 4.25, 4.5)),
}


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Words that lie in a window of ``WINDOW`` words found twice or more.

    Windows are compared by 64-bit hash.  Only texts with an equal pair sort
    their (hash, place) list; the places of equal neighbours, in order, each
    add what they cover beyond the one before.
    """

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def of(s: Column) -> Column:
            again = F.filter(
                F.transform(
                    s,
                    lambda x, k: F.when(
                        (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"]
                    ),
                ),
                lambda i: i.isNotNull(),
            )
            return _let(F.array_sort(again), lambda p: F.aggregate(F.transform(p, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - i, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, x: a + x))

        return _let(placed, of)

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - WINDOW + 1), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) < WINDOW + 1, F.lit(0).cast("long")).otherwise(
        _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))
    )


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; a null text has none of anything."""
    text = F.coalesce(F.col("__text"), F.lit(""))
    spaces = " \t\n\x0b\f\r"
    source = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("__text"))
    split = source.select(id_col, "__text", F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda x: x != "").alias("__words"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return split.select(
        id_col,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.translate(text, spaces, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("__words")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def stratum() -> Column:
    out = F.lit(0)
    for k, words in enumerate(STRATA, 1):
        out = F.when(F.col("n_words") >= words, k).otherwise(out)
    return out.cast("int")


def rates() -> dict[str, Column]:
    """What rules look at; all are defined for every text."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / chars,
        "repeats": F.col("n_repeat_words") / n,
        "dup_lines": 100 * F.col("n_dup_lines") / n,
        "long_words": F.col("word_chars") / n,
        "short_words": F.col("word_chars") / n,
    }


def _first_cutoff(rule: str) -> Column:
    """The place, from 1, of the first of a rule's cutoffs that rejects the row; all after it do too."""
    way, cutoffs = RULES[rule]
    value = rates()[rule]
    out = F.lit(0)
    for c in cutoffs:
        out = out + (value > c if way == "above" else value < c).cast("int")
    return (len(cutoffs) + 1 - out).cast("int")


def _log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series with the argument moved up by 8."""
    z = n + 9.0
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5.0)))
    below = F.lit(0.0)
    for k in range(1, 9):
        below = below + F.log(n + float(k))
    return series - below


def binomial_tail(x: Column, n: Column, risk: float) -> Column:
    """P(at most x of n) when each has the chance ``risk``, to double precision.

    Terms are added from x downwards as multiples of the first; those forty
    deviations below it can't be seen in a double.
    """
    steps = F.least(x, F.ceil(40 * F.sqrt(n * risk) + 100)).cast("int")
    first = _log_factorial(n) - _log_factorial(x) - _log_factorial(n - x) + x * math.log(risk) + (n - x) * math.log1p(-risk)
    odds = (1 - risk) / risk
    summed = F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(F.array().cast("array<int>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda a, k: F.struct(
            (a["term"] * (x - k) / (n - x + k + 1.0) * odds).alias("term"), (a["sum"] + a["term"] * (x - k) / (n - x + k + 1.0) * odds).alias("sum")
        ),
        lambda a: a["sum"],
    )
    return F.when(x >= n, 1.0).otherwise(F.least(F.lit(1.0), F.exp(first + F.log(summed))))


#: Steps of cutoffs.
STEPS = 12


def least_labels(risk: float, level: float) -> int:
    """Good documents without which not even a rule that rejects none of them could be told from a bad one."""
    return math.ceil(math.log(level) / math.log1p(-risk))


def _pools(counts: Column, least: int) -> Column:
    """For each stratum, by its count of labels, the number of its pool: neighbours go together until each pool has ``least``; what is left at the end goes with the last pool."""
    start = F.struct(F.lit(0).alias("pool"), F.lit(0).cast("long").alias("n"), F.array().cast("array<int>").alias("of"))

    def add(a: Column, n: Column) -> Column:
        full = a["n"] >= least
        return F.struct((a["pool"] + full.cast("int")).alias("pool"), (F.when(full, 0).otherwise(a["n"]) + n).alias("n"), F.array_append(a["of"], a["pool"] + full.cast("int")).alias("of"))

    return F.aggregate(counts, start, add, lambda a: F.transform(a["of"], lambda p: F.when((p == a["pool"]) & (a["n"] < least), F.greatest(a["pool"] - 1, F.lit(0))).otherwise(p)))


def cutoffs(measured: DataFrame, labels: DataFrame, label_col: str = "quality", risk: float = RISK, doubt: float = DOUBT, id_col: str = "doc_id") -> DataFrame:
    """(stratum, pool, labels, step): how many steps of their cutoffs the rules may take in each stratum.

    Labelled good documents that pass the base are the holdout.  At a step, x of
    a stratum's n would be rejected by any of the rules; if the true share were
    above ``risk``, x or fewer would come up with at most the binomial tail's
    chance.  Each step rejects what those before it do, so steps are tested in
    order at the same level, and the first that can't be told from a bad one
    ends the series: that keeps a stratum's error at one test's.  The doubt is
    shared equally by the strata (Bonferroni).  Neighbouring strata with fewer
    labels than a test needs are pooled, by their counts alone; if there aren't
    enough in all, no step is taken.  A document with contradicting labels is a
    good one.
    """
    level = doubt / (len(STRATA) + 1)
    least = least_labels(risk, level)
    good = labels.where((F.col(label_col) == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias(id_col)).distinct()
    held = measured.where(~base_failed()).join(good, id_col, "left_semi")
    at = F.least(*[_first_cutoff(r) for r in RULES])
    counted = held.select(stratum().alias("stratum"), at.alias("at")).groupBy("stratum", "at").agg(F.count("*").alias("n"))
    # from here on one row: at most strata * (steps + 1) counts
    number = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("long")
    strata = range(len(STRATA) + 1)
    by = counted.agg(
        F.array(*[number(F.col("stratum") == s) for s in strata]).alias("n"),
        F.array(*[F.array(*[number((F.col("stratum") == s) & (F.col("at") <= k)) for k in range(1, STEPS + 1)]) for s in strata]).alias("x"),
    )
    pooled = by.withColumn("pools", _pools(F.col("n"), least)).select("pools", "n", "x", F.explode(F.sequence(F.lit(0), F.lit(len(STRATA)))).alias("stratum"))
    pooled = pooled.withColumn("pool", F.get("pools", F.col("stratum")))
    mine = lambda values: F.aggregate(F.zip_with("pools", values, lambda p, v: F.when(p == F.col("pool"), v).otherwise(0)), F.lit(0).cast("long"), lambda a, v: a + v)
    step = F.explode(F.sequence(F.lit(1), F.lit(STEPS))).alias("step")
    tried = pooled.select("stratum", "pool", "pools", "x", mine(F.col("n")).cast("double").alias("labels"), step)
    tried = tried.select("stratum", "pool", "labels", "step", mine(F.transform("x", lambda v: F.get(v, F.col("step") - 1))).cast("double").alias("rejected"))
    tested = tried.withColumn("bad", (F.col("labels") < least) | (binomial_tail(F.col("rejected"), F.col("labels"), risk) > level))
    ended = F.coalesce(F.min(F.when(F.col("bad"), F.col("step"))) - 1, F.lit(STEPS)).cast("int").alias("step")
    return tested.groupBy("stratum", "pool", F.col("labels").cast("long").alias("labels")).agg(ended)


def judge(docs: DataFrame, labels: DataFrame, store: Store | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """Each row's measures, stratum, base_failed, kept and the first rule that rejects it (``rejected_by``).

    A row is kept if it passes the base and no rule, at the step that its
    stratum's labels vouch for (see ``cutoffs``), rejects it.  Rows are judged
    by themselves; a row without an id teaches nothing but is judged.  An empty
    table gives an empty result, and without labels only the base rejects.
    """
    store = store or Store(docs.sparkSession, "rules")
    measured = store.put(measures(docs, id_col, text_col), "measures")
    chosen = store.put(cutoffs(measured, labels, label_col, risk, doubt, id_col), "cutoffs")
    # one row for each stratum
    limits = chosen.select(F.col("stratum").alias("__of"), F.col("step").alias("__step"))
    judged = measured.withColumn("stratum", stratum()).join(F.broadcast(limits), F.col("stratum") == F.col("__of"), "left")
    rejected_by = F.when(base_failed(), "base")
    for rule in RULES:
        rejected_by = rejected_by.when(_first_cutoff(rule) <= F.col("__step"), rule)
    return judged.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), rejected_by.isNull().alias("kept"), "stratum", rejected_by.alias("rejected_by")
    )
