"""Files into DataFrames, with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.sources import zstd

def parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``value`` and ``file`` of each line that isn't blank, without white space at its ends."""
    text = spark.read.text(path).select(F.trim("value").alias("value"), F.col("_metadata.file_name").alias("file"))
    return text.where("value <> ''")


def jsonl(spark: SparkSession, path: str, schema: T.StructType, limit: int | None = None) -> DataFrame:
    """Rows of a JSON lines file; malformed lines and lines that aren't objects are left out (see ``jsonl_stats``)."""
    found = lines(spark, path)
    found = found if limit is None else found.limit(limit)
    return parsed(found, schema)


def parsed(found: DataFrame, schema: T.StructType) -> DataFrame:
    good = found.where(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"))
    return good.select(F.from_json("value", schema).alias("r")).select("r.*")


def jsonl_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row: lines that aren't blank, and how many of them are malformed."""
    return lines(spark, path).agg(F.count("*").alias("total"), F.count_if(F.try_parse_json("value").isNull()).alias("malformed"))


def json_document(spark: SparkSession, path: str, schema: T.StructType, part: str) -> DataFrame:
    """The rows of the list ``part`` of a JSON document."""
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.inline(part))


def csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def rows(spark: SparkSession, records: list[dict], schema: T.StructType) -> DataFrame:
    """Records in memory; fields that are missing are null, others go."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in records], schema)


def zstd_lines(spark: SparkSession, path: str, run: int = zstd.RUN) -> DataFrame:
    """``value`` of each line of zstd files that isn't blank, by runs of frames; see ``zstd.ZstdLines``."""
    spark.dataSource.register(zstd.ZstdLines)
    return spark.read.format("zstd_lines").option("bytes", run).load(path)


def batch_results(spark: SparkSession, pattern: str) -> DataFrame:
    """custom_id, result_type, content, tokens, error of result files; success without content is an error."""
    usage = T.StructType([T.StructField("input_tokens", T.LongType()), T.StructField("output_tokens", T.LongType())])
    part = T.StructType([T.StructField("text", T.StringType())])
    message = T.StructType([T.StructField("content", T.ArrayType(part)), T.StructField("usage", usage)])
    result = T.StructType([T.StructField("type", T.StringType()), T.StructField("message", message), T.StructField("error", T.StringType())])
    schema = T.StructType([T.StructField("custom_id", T.StringType()), T.StructField("result", result)])
    r = jsonl(spark, pattern, schema)
    text = F.get(F.col("result.message.content"), 0)["text"]
    done = (F.col("result.type") == "succeeded") & text.isNotNull()
    return r.select(
        "custom_id",
        F.when(F.col("result.type") == "succeeded", F.when(text.isNotNull(), "succeeded").otherwise("errored")).otherwise(F.col("result.type")).alias("result_type"),
        F.when(done, text).alias("content"),
        F.when(done, F.col("result.message.usage.input_tokens")).alias("input_tokens"),
        F.when(done, F.col("result.message.usage.output_tokens")).alias("output_tokens"),
        F.when(~done, F.coalesce("result.error", F.lit("no content"))).alias("error"),
    )


def rows_per_file(spark: SparkSession, pattern: str) -> DataFrame:
    return lines(spark, pattern).groupBy("file").agg(F.count("*").alias("rows"))
