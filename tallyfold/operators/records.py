"""Cleaning of records: predicates, projection and ordered steps with counts of what each rejects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyfold.schemas import COMMENT

#: Bodies of comments that are gone.
GONE = ("[deleted]", "[removed]")


def has_valid_body(body: Column | str = "body") -> Column:
    c = F.col(body) if isinstance(body, str) else body
    return c.isNotNull() & ~c.isin("", *GONE)


def from_source(names: list[str], source: Column | str = "subreddit") -> Column:
    """Whether the source, in lower case, is one of ``names``; a missing one isn't."""
    c = F.col(source) if isinstance(source, str) else source
    return F.lower(F.coalesce(c, F.lit(""))).isin([n.lower() for n in names])


def extract_fields(rows: DataFrame) -> DataFrame:
    """The fields of a comment in their order; those that are missing are null, others go."""
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in COMMENT.fields])


@dataclass(frozen=True)
class Step:
    """A predicate that rows have to pass, under a name."""

    name: str
    passes: Column


class Steps:
    """Steps in order.  A row that fails is credited to the first step it fails; later steps don't see it."""

    def __init__(self, *steps: Step):
        self.steps = steps

    def reason(self) -> Column:
        """The name of the first step that a row fails, null if it passes all."""
        out = None
        for s in self.steps:
            fails = ~F.coalesce(s.passes, F.lit(False))
            out = F.when(fails, s.name) if out is None else out.when(fails, s.name)
        return F.lit(None).cast("string") if out is None else out

    def accepted(self, rows: DataFrame, observation: Observation | None = None) -> DataFrame:
        """Rows that pass; with ``observation``, the counts come out of the same run."""
        if observation is None:
            keep = F.lit(True)
            for s in self.steps:
                keep = keep & F.coalesce(s.passes, F.lit(False))
            return rows.where(keep)
        named = rows.withColumn("__reason", self.reason())
        counts = [F.count("*").alias("total"), F.count_if(F.col("__reason").isNull()).alias("accepted")]
        counts += [F.count_if(F.col("__reason") == s.name).alias(f"rejected_{s.name}") for s in self.steps]
        return named.observe(observation, *counts).where(F.col("__reason").isNull()).drop("__reason")

    def stats(self, rows: DataFrame) -> DataFrame:
        """One row: total, accepted and rejected_<name> for each step."""
        named = rows.select(self.reason().alias("__reason"))
        return named.agg(
            F.count("*").alias("total"), F.count_if(F.col("__reason").isNull()).alias("accepted"), *[F.count_if(F.col("__reason") == s.name).alias(f"rejected_{s.name}") for s in self.steps]
        )
