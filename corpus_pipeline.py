"""A corpus from raw documents to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before it
kept, and returns the columns of documents; the last returns the digests of the
encoded texts.  ``run`` applies them in turn to the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import bpe, minhash, mixing, passages, quality
from tallyfold.llm.store import Store, whole_row

#: Documents of a lower quality score go.
LEAST_QUALITY = 0.3


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; it learns from all labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels)
    # whole rows are carried as one column, so that no name of theirs meets one of the classifier's
    rows = docs.select("doc_id", "text", whole_row(docs).alias("row"))
    return quality.score(rows, model, carry=("row",)).where(F.col("score") >= LEAST_QUALITY).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest id, once."""
    return minhash.representatives(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated passages; those of which nothing is left go."""
    cut = passages.cut(docs.select("doc_id", "text", whole_row(docs, without=("text",)).alias("row")))
    untouched = F.size("cut_spans") == 0
    whole = untouched | F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    kept = cut.where(F.coalesce(whole, F.lit(True)))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(untouched, F.col("row.n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of training."""
    return mixing.arranged(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, as digests, with the number of tokens."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, break_at_space=True, ids=True, digests=True)


STAGES = [
    ("quality classifier", classify),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", passage_dedup),
    ("mixing", mix),
    ("BPE", encode),
]

#: The classifier's scores can't be said in SQL; stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``; each stage's result is written and read again."""
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = store.put(stage(spark, docs, sf_dir), f"stage-{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
