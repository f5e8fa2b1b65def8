"""A bounded sample of labelled rows, for fitting on the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import minhash, tokens

#: Rows of each label, and bytes of text, that a classifier is fitted on at most.
ROWS_PER_LABEL, TEXT_BYTES = 3000, 24 << 20


def counts(labels: DataFrame, label_col: str) -> dict[int, int]:
    """All labelled rows by label, 0 and 1."""
    found = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(label_col).cast("int").alias("y")).count().collect()
    return {0: 0, 1: 0} | {r["y"]: r["count"] for r in found}


def looks(text: str) -> set[tuple[int, int]]:
    """Four minima of the text's shingles: near copies share one, unrelated texts don't."""
    runs, first = tokens.shingles(next(tokens.text_chunks(pa.array([text], pa.string())))[2], minhash.SHINGLE)
    return set(enumerate(minhash.signatures(runs, first, 4)[0].tolist()))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int = ROWS_PER_LABEL, text_bytes: int = TEXT_BYTES) -> Iterator[tuple[int, str]]:
    """(label, whole text) of up to ``rows`` texts of each label, the lowest hashes of ids first.

    A text that resembles one before it is left out, or its words would look
    typical of a label, and so is one that would exceed ``text_bytes``.
    Labels other than 0 and 1, and rows without an id or a text, teach nothing;
    a document with contradicting labels is an example of both.
    """
    named = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label_col).cast("int").alias("__y"))
    picked = None
    for y in (0, 1):
        some = named.where(F.col("__y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        picked = some if picked is None else picked.union(some)
    # at most 2 * rows ids, so the broadcast has a bound
    found = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(picked), "doc_id")
    room, seen = text_bytes, set()
    for row in found.orderBy(F.xxhash64("doc_id"), "doc_id", "text").toLocalIterator():
        size, keys = len(row["text"]) * 2, looks(row["text"])
        if size > room or keys & seen:
            continue
        seen |= keys
        room -= size
        yield row["__y"], row["text"]
