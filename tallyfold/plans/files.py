"""Tables written as files and read back: what sources and sinks make of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.text import batch_number
from tallyfold.operators import labels as L
from tallyfold.plans.adapters import RAW, RESULTS, raw, results
from tallyfold.plans.registry import query, table
from tallyfold.sources import batches, readers, scratch, writers


@query(
    "batch_files",
    """WITH n AS (SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // 60 + 1 AS batch_num FROM documents)
SELECT 'batch_' || lpad(CAST(batch_num AS VARCHAR), CAST(greatest(3, length(CAST(batch_num AS VARCHAR))) AS INTEGER), '0') || '.jsonl' AS file, CAST(batch_num AS INTEGER) AS batch_num, count(*) AS n,
  min(doc_id) AS first_id, max(doc_id) AS last_id, CAST(sum(length(text)) AS BIGINT) AS chars FROM n GROUP BY batch_num""",
)
def _(spark, d):
    path = scratch.folder(spark, "batch-files")
    batches.write(table(spark, d, "documents").select("doc_id", "text"), path, "doc_id", 60)
    rows = readers.lines(spark, path).select("file", F.from_json("value", "doc_id long, text string").alias("r"))
    by = rows.groupBy("file").agg(F.count("*").alias("n"), F.min("r.doc_id").alias("first_id"), F.max("r.doc_id").alias("last_id"), F.sum(F.length("r.text")).alias("chars"))
    return by.withColumn("batch_num", batch_number(F.col("file")))


@query(
    "jsonl_round_trip",
    f"WITH {RAW} SELECT id, subreddit, CASE WHEN body IS NULL THEN NULL ELSE md5(body) END AS body_md5, n_chars FROM raw WHERE id % 4 <> 1 OR id % 8 = 5",
)
def _(spark, d):
    """Some lines are broken, some are lists, some blank, some appended later."""
    path = scratch.folder(spark, "jsonl")
    rows = raw(spark, d).select("id", "body", "subreddit", "n_chars")
    line = F.to_json(F.struct(*rows.columns))
    kind = F.col("id") % 4
    text = F.when(kind == 1, F.element_at(F.array(F.lit("{broken"), F.concat(F.lit("["), line, F.lit("]")), F.lit("  "), F.lit('"text"')), (F.col("id") % 3 + 1).cast("int"))).otherwise(F.concat(F.lit(" "), line))
    rows.select(text.alias("value")).write.text(path)
    writers.jsonl(rows.where("id % 8 = 5"), path, append=True)
    return readers.jsonl(spark, path, rows.schema).select("id", "subreddit", F.md5("body").alias("body_md5"), "n_chars")


@query("jsonl_line_counts", f"WITH {RAW} SELECT count(*) AS total, count(*) FILTER (id % 4 = 1) AS malformed FROM raw")
def _(spark, d):
    path = scratch.folder(spark, "lines")
    rows = raw(spark, d).select("id", "body")
    rows.select(F.when(F.col("id") % 4 == 1, "{broken").otherwise(F.to_json(F.struct("id", "body"))).alias("value")).union(rows.select(F.lit("   ")).limit(3)).write.text(path)
    return readers.jsonl_stats(spark, path)


@query("csv_round_trip", "SELECT event_id, nullif(event_type, 'click') AS event_type, value, CASE WHEN event_id % 2 = 0 THEN 'a, \"b\"' END AS note FROM events")
def _(spark, d):
    path = scratch.folder(spark, "csv")
    rows = table(spark, d, "events").select("event_id", F.nullif("event_type", F.lit("click")).alias("event_type"), "value", F.when(F.col("event_id") % 2 == 0, 'a, "b"').alias("note"))
    writers.csv(rows, path)
    return readers.csv(spark, path, rows.schema)


@query("parquet_round_trip", "SELECT o_orderpriority AS priority, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
def _(spark, d):
    path = scratch.folder(spark, "parquet")
    writers.parquet(table(spark, d, "orders").select("o_orderpriority", "o_custkey"), path)
    return readers.parquet(spark, path).groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"), F.sum("o_custkey").cast("long").alias("keys"))


_RESULT = "result_type = 'succeeded' AND CAST(custom_id AS BIGINT) % 19 <> 0"


@query(
    "result_files",
    f"""WITH {RESULTS}
SELECT custom_id, CASE WHEN {_RESULT} THEN 'succeeded' WHEN result_type = 'succeeded' THEN 'errored' ELSE result_type END AS result_type,
  CASE WHEN {_RESULT} THEN CASE form WHEN 4 THEN '[]' WHEN 6 THEN 'not json' WHEN 7 THEN '  ' ELSE 'reply' END END AS content,
  CASE WHEN {_RESULT} THEN input_tokens END AS input_tokens, CASE WHEN {_RESULT} THEN output_tokens END AS output_tokens FROM results""",
)
def _(spark, d):
    """Results as a service writes them, in several files; every nineteenth success has no content."""
    path = scratch.folder(spark, "results")
    found = results(spark, d)
    part = F.struct(F.col("content").alias("text"))
    empty = F.col("custom_id").cast("long") % 19 == 0
    message = F.struct(F.when(empty, F.array().cast("array<struct<text:string>>")).otherwise(F.array(part)).alias("content"), F.struct("input_tokens", "output_tokens").alias("usage"))
    result = F.struct(F.col("result_type").alias("type"), F.when(F.col("result_type") == "succeeded", message).alias("message"))
    writers.jsonl(found.select("custom_id", result.alias("result")), path)
    read = readers.batch_results(spark, f"{path}/part-*")
    plain = F.col("content").isNull() | F.col("content").isin("[]", "not json", "  ")
    return read.select("custom_id", "result_type", F.when(plain, F.col("content")).otherwise("reply").alias("content"), "input_tokens", "output_tokens")


@query(
    "dead_letter_files",
    f"WITH {RESULTS} SELECT 'good' AS part, count(*) AS n FROM results WHERE result_type = 'succeeded' UNION ALL SELECT 'dead ' || result_type, count(*) FROM results WHERE result_type <> 'succeeded' GROUP BY result_type",
)
def _(spark, d):
    good, dead = scratch.folder(spark, "good"), scratch.folder(spark, "dead")
    writers.split_results(results(spark, d), good, dead)
    letters = spark.read.schema("custom_id string, result_type string").json(dead).groupBy(F.concat(F.lit("dead "), "result_type").alias("part")).agg(F.count("*").alias("n"))
    return readers.parquet(spark, good).agg(F.lit("good").alias("part"), F.count("*").alias("n")).union(letters)


@query("request_checks", "SELECT CASE WHEN doc_id % 50 = 7 THEN 'broken' ELSE 'whole' END AS kind, count(*) AS n FROM documents GROUP BY 1")
def _(spark, d):
    """Request files of 40 rows in which some lines are broken, read back line by line."""
    path = scratch.folder(spark, "requests")
    rows = L.requests(table(spark, d, "documents"), "m-1", key="doc_id", body="text")
    batches.write(rows.withColumn("key", F.col("custom_id").cast("long")), path, "key", 40)
    lines = readers.lines(spark, path)
    broken = F.get_json_object("value", "$.custom_id").cast("long") % 50 == 7
    damaged = lines.select("file", F.monotonically_increasing_id().alias("line"), F.when(broken, F.substring("value", 1, 20)).otherwise(F.col("value")).alias("value"))
    whole = F.try_parse_json("value").isNotNull()
    return damaged.groupBy(F.when(whole, "whole").otherwise("broken").alias("kind")).agg(F.count("*").alias("n"))


@query(
    "zstd_round_trip",
    f"WITH {RAW} SELECT id, subreddit, CASE WHEN body IS NULL THEN NULL ELSE md5(body) END AS body_md5 FROM raw WHERE id % 7 <> 2",
)
def _(spark, d):
    """Records as lines of zstd files in frames of 100 kB, read by runs of about as much; every seventh line is broken."""
    path = scratch.folder(spark, "zstd")
    rows = raw(spark, d).select("id", "body", "subreddit")
    line = F.to_json(F.struct(*rows.columns))
    writers.zstd_lines(rows.select(F.when(F.col("id") % 7 == 2, F.substring(line, 1, 9)).otherwise(line).alias("value")), path, frame=100_000)
    found = readers.parsed(readers.zstd_lines(spark, path, run=50_000), rows.schema)
    return found.select("id", "subreddit", F.md5("body").alias("body_md5"))
