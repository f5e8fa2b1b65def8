"""Grouped sentiment metrics and the views built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.numbers import rate


def metric_columns() -> list[Column]:
    """Counts of each label and of all rows."""
    return [
        F.count_if(F.col("sentiment") == "neg").alias("neg_count"),
        F.count_if(F.col("sentiment") == "pos").alias("pos_count"),
        F.count_if(F.col("sentiment") == "neu").alias("neu_count"),
        F.count("*").alias("comment_count"),
    ]


def with_rates(counted: DataFrame) -> DataFrame:
    n = F.col("comment_count")
    return counted.withColumns(
        {
            "neg_rate": rate(F.col("neg_count"), n),
            "pos_rate": rate(F.col("pos_count"), n),
            "net_sentiment": rate(F.col("pos_count") - F.col("neg_count"), n),
            "polarization": rate(F.col("pos_count") + F.col("neg_count"), n),
        }
    )


def compute_metrics(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of labels and their rates by the keys; the rates are of all rows of a group."""
    return with_rates(rows.groupBy(*keys).agg(*metric_columns()))


def usable(rows: DataFrame) -> DataFrame:
    """Rows whose label is known and isn't an error."""
    return rows.where(F.col("sentiment") != "error")


def by_entity(rows: DataFrame) -> DataFrame:
    return compute_metrics(usable(rows).where(F.col("entity").isNotNull()), ["entity"])


def by_entity_week(rows: DataFrame) -> DataFrame:
    return compute_metrics(usable(rows).where(F.col("entity").isNotNull()), ["entity", "week"])


def by_entity_team(rows: DataFrame) -> DataFrame:
    return compute_metrics(usable(rows).where(F.col("entity").isNotNull() & F.col("team").isNotNull()), ["entity", "team"])


def by_team(rows: DataFrame, teams: DataFrame) -> DataFrame:
    """Metrics of each team, rows without an entity included, with the team's columns."""
    return compute_metrics(usable(rows).where(F.col("team").isNotNull()), ["team"]).join(teams, "team", "left")


def all_views(rows: DataFrame) -> DataFrame:
    """The four views in one pass over the rows: ``view`` names the keys that are set."""
    grouped = usable(rows).groupingSets([["entity"], ["entity", "week"], ["entity", "team"], ["team"]], "entity", "week", "team").agg(
        *metric_columns(), F.grouping_id().alias("level")
    )
    named = grouped.withColumn("view", F.element_at(F.create_map(*[F.lit(x) for x in (3, "entity", 1, "entity_week", 2, "entity_team", 6, "team")]), F.col("level").cast("int")))
    real = (F.col("entity").isNotNull() | (F.col("view") == "team")) & (F.col("team").isNotNull() | ~F.col("view").isin("entity_team", "team"))
    return with_rates(named.where(real).drop("level"))


def run_metadata(rows: DataFrame) -> DataFrame:
    """One row: how many comments there are, are usable and are attributed, and of how many entities, teams and weeks.

    A null week counts as a week.
    """
    good = F.col("sentiment") != "error"
    counted = rows.agg(
        F.count("*").alias("total_comments"),
        F.count_if(good).alias("usable_comments"),
        F.count_if(good & F.col("entity").isNotNull()).alias("attributed_comments"),
        F.countDistinct(F.when(good, F.col("entity"))).alias("entity_count"),
        F.countDistinct(F.when(good, F.col("team"))).alias("team_count"),
        (F.countDistinct(F.when(good, F.col("week"))) + F.coalesce(F.max(F.when(good & F.col("week").isNull(), 1).otherwise(0)), F.lit(0))).alias("week_count"),
    )
    return counted.withColumn("excluded_comments", F.col("total_comments") - F.col("usable_comments"))


def enriched(rows: DataFrame, dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows with those of the columns that the dimension has; rows stay as many as they are."""
    return rows.join(dim.select(key, *[c for c in columns if c in dim.columns]).dropDuplicates([key]), key, "left")


def seen_only(dim: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return dim.join(rows.select(key).distinct(), key, "left_semi")


def attribution_classes(rows: DataFrame) -> DataFrame:
    """How many usable rows fall in each of five classes, and what percentage."""
    n = F.size("mentions")
    kind = (
        F.when(n == 1, "single")
        .when((n >= 2) & F.col("entity").isNotNull(), "resolved")
        .when((n >= 2) & F.col("label_entity").isNull(), "no_label")
        .when(n >= 2, "unresolved")
        .otherwise("no_mention")
    )
    counted = usable(rows).groupBy(kind.alias("class")).agg(F.count("*").alias("n"))
    total = usable(rows).agg(F.count("*").alias("total"))
    return counted.crossJoin(F.broadcast(total)).select("class", "n", rate(100 * F.col("n"), F.col("total"), 2).alias("pct"))


def sanity_checks(rows: DataFrame) -> DataFrame:
    """(check, ok): the counts of the views add up."""
    meta, overall, weekly = run_metadata(rows), by_entity(rows), by_entity_week(rows)
    sums = overall.agg(
        F.sum("comment_count").alias("in_views"),
        F.max(F.abs(F.col("neg_count") + F.col("pos_count") + F.col("neu_count") - F.col("comment_count"))).alias("gap"),
        F.max(F.abs(rate(F.col("pos_count") - F.col("neg_count"), F.col("comment_count")) - F.col("net_sentiment"))).alias("net_gap"),
    )
    weeks = weekly.agg(F.sum("comment_count").alias("in_weeks"))
    one = meta.crossJoin(F.broadcast(sums)).crossJoin(F.broadcast(weeks))
    checks = {
        "funnel": F.col("total_comments") - F.col("excluded_comments") == F.col("usable_comments"),
        "attributed": F.col("in_views") == F.col("attributed_comments"),
        "weekly": F.col("in_weeks") == F.col("in_views"),
        "labels": F.col("gap") == 0,
        "net": F.col("net_gap") < 1e-9,
    }
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.coalesce(v, F.lit(False)).alias("ok")) for k, v in checks.items()])).alias("x")).select("x.check", "x.ok")
