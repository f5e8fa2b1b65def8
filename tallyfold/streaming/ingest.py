"""JSON lines from a landing folder: clean, match, count by week, as they come."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyfold.operators.matching import Name, mentions
from tallyfold.operators.records import Step, Steps, extract_fields, has_valid_body
from tallyfold.schemas import COMMENT
from tallyfold.sources.readers import parsed

#: How long after its own time a comment may come.
LATE = "2 days"


def comments(spark: SparkSession, path: str) -> DataFrame:
    """Accepted comments of the folder's files, each id once within ``LATE``."""
    text = spark.readStream.text(path).select(F.trim("value").alias("value")).where("value <> ''")
    clean = Steps(Step("has_valid_body", has_valid_body())).accepted(extract_fields(parsed(text, COMMENT)))
    timed = clean.withColumn("created_at", F.timestamp_seconds("created_utc")).withWatermark("created_at", LATE)
    return timed.dropDuplicatesWithinWatermark(["id"])


def mentioning(rows: DataFrame, names: Iterable[Name], short: frozenset[str] = frozenset()) -> DataFrame:
    found = rows.withColumn("mentioned_entities", mentions(F.col("body"), names, short))
    return found.where(F.size("mentioned_entities") > 0)


def weekly(rows: DataFrame) -> DataFrame:
    """Mentions of each entity by week from Monday; a week is given once it can't change any more."""
    each = rows.select("created_at", F.explode("mentioned_entities").alias("entity"))
    # the epoch was a Thursday
    return each.groupBy(F.window("created_at", "1 week", startTime="4 days"), "entity").agg(F.count("*").alias("n")).select(F.to_date("window.start").alias("week"), "entity", "n")


def run_once(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends what has come since the last run to Parquet; each comment once, whatever fails between."""
    query = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query
