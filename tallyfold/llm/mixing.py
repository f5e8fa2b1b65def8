"""Mixing sources to target weights by a curriculum whose weights change over the course of training.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.llm.store import Store, whole_row

#: Weights that sources have in turn, and how often a document may be taken.
WEIGHTS, MOST = (5.0, 2.0, 1.0), 3
#: Of what the schedule gives a source, the part by which its rate rises (or falls) from the middle of training to its
#: end.  Sources take these in turn as they do the weights, so some come early and some late; what all together would
#: rise is taken off each, so that the rates of all sources add up to the whole at each time.
SLOPES = (-0.5, 0.25, 0.5)
#: Hexadecimal digits of the order that name a part of a source; parts are added up by themselves before rows are
#: put in order within them, so a source may hold most rows.
PART_DIGITS = 3


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, slopes: tuple[float, ...] = SLOPES) -> DataFrame:
    """``sizes(source, source_size)`` with place (by code point, null last), weight, slope and target.

    All targets add up to all sizes.  A source gets its weight's share, but at
    most ``most`` times its size; what that leaves goes to the others by weight.
    With the sources in the order of most * size / weight, the full ones are a
    prefix, so the level at which the rest stand follows from running sums.
    One row for each source: as many rows as there are sources, not documents.
    """
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.col("place") % len(weights)).cast("int")
    named = sizes.withColumn("place", F.row_number().over(by_name) - 1).select(
        "*",
        F.element_at(F.array(*map(F.lit, weights)), turn + 1).alias("weight"),
        F.element_at(F.array(*map(F.lit, slopes)), (F.col("place") % len(slopes)).cast("int") + 1).alias("slope"),
    )
    full = most * F.col("source_size") / F.col("weight")
    order = Window.orderBy("full", "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0))) / F.sum("weight").over(after)
    stepped = named.select("*", full.alias("full"), F.sum("source_size").over(everything).alias("total")).withColumn("level", level)
    # the first source that isn't full at the level for itself and all after it sets the level
    found = stepped.withColumn("line", F.min(F.when(F.col("full") > F.col("level"), F.struct("full", "place", "level"))).over(everything)["level"])
    aimed = found.select(
        "source",
        "source_size",
        "place",
        "weight",
        "slope",
        F.when(F.col("source_size") == 0, 0.0).when(F.col("full") <= F.coalesce("line", F.lit(float("inf"))), most * F.col("source_size").cast("double")).otherwise(F.col("line") * F.col("weight")).alias("target"),
    )
    rise = F.sum(F.col("target") * F.col("slope")).over(everything) / F.greatest(F.sum("target").over(everything), F.lit(1.0))
    return aimed.withColumn("slope", F.col("slope") - rise)


def _mark(id_col: str, text_col: str, source_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"), F.col(source_col).cast("string"))


def position(done: Column, slope: Column) -> Column:
    """The time, of 0 to 1, by which a source's schedule has demanded the part ``done`` of its target.

    Its rate at time t is 1 + slope * (2t - 1) of the mean; the integral, t + slope * (t * t - t), is inverted.
    """
    a = 1 - slope
    root = F.sqrt(F.greatest(F.lit(0.0), a * a + 4 * slope * done))
    return F.when(F.abs(slope) < 1e-9, done).otherwise(2 * done / (a + root))


def curriculum(docs: DataFrame, store: Store | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", most: int = MOST) -> DataFrame:
    """One row for each row of ``docs``: id, mark (of id, text and source), size, source, source_size, target, taken, copies, positions.

    Documents of a source lie one behind the other in the order of the md5 of
    their ids, and again for each further round.  A source's rate of words over
    the time of training is its schedule; a copy of a document is due when the
    integral has reached the middle of its words, and the inverted integral is
    its place in training, of 0 to 1, the same clock for all sources.  Copies
    that the whole schedule doesn't reach, as it gives the source's target, are
    not taken.  ``positions`` are those that are, one for each copy.

    A null source is a source; null and empty texts have size 0 and aren't
    taken.  Rows that agree in id, text and source share a place and differ by
    nothing, so any order of them gives the same result; a row without an id is
    a row like others.  An empty table gives an empty result.
    """
    store = store or Store(docs.sparkSession, "mixing")
    measured = store.put(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(source_col).cast("string").alias("source"),
            n_words(F.col(text_col)).alias("size"),
            F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("order"),
            _mark(id_col, text_col, source_col).alias("mark"),
        ),
        "sizes",
    )
    part = F.substring("order", 1, PART_DIGITS)
    parts = measured.groupBy("source", part.alias("part")).agg(F.sum("size").alias("words"))
    of_source = Window.partitionBy("source").orderBy("part")
    # at most 16^PART_DIGITS rows for each source
    sums = parts.select("source", "part", F.coalesce(F.sum("words").over(of_source.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    sizes = parts.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = store.put(targets(sizes, most=most), "targets")
    heads = store.put(
        sums.join(plan, sums["source"].eqNullSafe(plan["source"])).select(sums["source"].alias("source"), "part", "ahead", "source_size", "target", "slope"), "parts"
    )
    here = measured.withColumn("part", part)
    joined = here.join(heads.withColumnRenamed("source", "head_source").withColumnRenamed("part", "head_part"), here["source"].eqNullSafe(F.col("head_source")) & (here["part"] == F.col("head_part")))
    inside = Window.partitionBy("source", "part").orderBy("order", "size", "mark").rowsBetween(Window.unboundedPreceding, -1)
    placed = joined.withColumn("begin", F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # the words that the source has to have given when a round comes to the middle of the document
    due = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda r: F.col("begin") + F.col("size") / 2 + r * F.col("source_size"))
    reached = F.when(F.col("size") > 0, F.filter(due, lambda d: d < F.col("target"))).otherwise(F.array().cast("array<double>"))
    positions = F.transform(reached, lambda d: position(d / F.col("target"), F.col("slope")))
    return placed.withColumn("positions", positions).select(
        F.col("id").alias(id_col),
        "mark",
        "size",
        "source",
        "source_size",
        "target",
        (F.size("positions") * F.col("size")).cast("long").alias("taken"),
        F.size("positions").alias("copies"),
        "positions",
    )


def in_order(placed: DataFrame, at: str, spread: str) -> DataFrame:
    """Rows sorted by range of a position of 0 to 1, so that a hot source is dealt over all tasks; those without one follow, by the hash of ``spread``."""
    parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col(at), 1 + F.shiftrightunsigned(F.xxhash64(spread), 11) / float(1 << 53))
    return placed.withColumn("__key", key).repartitionByRange(parts, "__key").sortWithinPartitions("__key").drop("__key")


def arranged(docs: DataFrame, store: Store | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` as the mix has them: each as often as it is taken, sorted by training position.

    Rows keep their columns, whatever their names.  Of rows that agree in id,
    text and source, each goes as often as the one that goes most often.
    """
    store = store or Store(docs.sparkSession, "mixing")
    plan = curriculum(docs, store, id_col, text_col, source_col)
    copies = plan.select(F.col(id_col).alias("__id"), F.col("mark").alias("__of"), F.posexplode("positions").alias("__round", "__at"))
    placed = copies.dropDuplicates(["__id", "__of", "__round"])
    rows = docs.select(whole_row(docs).alias("row"), F.col(id_col).cast("long").alias("of"), _mark(id_col, text_col, source_col).alias("mark"))
    together = rows.join(placed, (F.col("mark") == F.col("__of")) & F.col("of").eqNullSafe(F.col("__id")))
    return in_order(together, "__at", "mark").select("row.*")
