"""Fingerprints of documents: every shingle hash below a fixed fraction of the hash range."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import tokens

#: Words in a shingle.
WORDS = 5
#: The share of hashes that is kept, and how many a text has at least, as long as it has so many.
FRACTION, LEAST = 1 / 64, 64
_TOP = 2**64 - 1
#: Sampled keys for each range of ids.
SAMPLED = 64


@dataclass(frozen=True)
class Sketch:
    """The distinct hashes up to ``bound``, in order; there are no others of the set up to there."""

    bound: int
    hashes: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, fraction: float = FRACTION, least: int = LEAST) -> Sketch:
        """Of a set of 64-bit hashes: all below the fraction.

        A set with fewer than ``least`` of them keeps its ``least`` lowest, and
        says so by its bound, so that short texts can be compared too.
        """
        own = np.unique(hashes)
        if len(own) <= least:
            return cls(_TOP, own)
        bound = max(int(fraction * 2.0**64), int(own[least - 1]))
        return cls(bound, own[: int(np.searchsorted(own, np.uint64(bound), side="right"))])

    def text(self) -> str:
        return base64.b64encode(np.concatenate([np.array([self.bound], np.uint64), self.hashes]).astype(">u8").tobytes()).decode()

    @classmethod
    def parse(cls, text: str) -> Sketch:
        raw = np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)
        return cls(int(raw[0]), raw[1:])

    def upto(self, bound: int) -> np.ndarray:
        return self.hashes[: int(np.searchsorted(self.hashes, np.uint64(bound), side="right"))]

    def merged(self, other: Sketch) -> Sketch:
        """The sketch of the union of both sets."""
        bound = min(self.bound, other.bound)
        return Sketch(bound, np.union1d(self.upto(bound), other.upto(bound)))

    def compared(self, other: Sketch) -> tuple[float, float, float]:
        """Estimates of the sets' Jaccard similarity, and of the shares of the first and of the second that the other holds.

        Both are looked at up to the lower bound, below which both are whole.
        Two empty sets are alike; an empty one holds, and shares, nothing of
        another.
        """
        bound = min(self.bound, other.bound)
        a, b = self.upto(bound), other.upto(bound)
        both = len(np.intersect1d(a, b, assume_unique=True))
        if not len(self.hashes) and not len(other.hashes):
            return 1.0, 1.0, 1.0
        return both / max(1, len(a) + len(b) - both), both / max(1, len(a)), both / max(1, len(b))


def sketched(column: pa.Array, fraction: float = FRACTION, least: int = LEAST) -> list[Sketch]:
    """Sketches of a column of texts."""
    out: list[Sketch] = []
    for _, _, w in tokens.text_chunks(column):
        runs, first = tokens.shingles(w, WORDS)
        out += [Sketch.of(runs[a:z], fraction, least) for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fraction: float = FRACTION, least: int = LEAST) -> DataFrame:
    """Each row's id and fingerprint; see ``Sketch``.

    Shingles are runs of five words, lower-cased; a text of fewer words is one
    shingle, and one that is null, empty or without words has an empty set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([s.text() for s in sketched(batch.column(1), fraction, least)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["id", "fingerprint"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "id long, fingerprint string").withColumnRenamed("id", id_col)


def compared(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with near, a_in_b and b_in_a (see ``Sketch.compared``) of two columns of fingerprints; null where one is."""

    @F.pandas_udf("near double, a_in_b double, b_in_a double")
    def of(x, y):
        import pandas as pd

        found = [Sketch.parse(p).compared(Sketch.parse(q)) if p is not None and q is not None else (None,) * 3 for p, q in zip(x, y, strict=True)]
        return pd.DataFrame(found, columns=["near", "a_in_b", "b_in_a"], dtype="float64")

    return pairs.withColumn("__of", of(F.col(a), F.col(b))).select(*pairs.columns, "__of.near", "__of.a_in_b", "__of.b_in_a")


def merged(rows: DataFrame, keys: list[str], column: str = "fingerprint") -> DataFrame:
    """(keys, fingerprint): the fingerprint of all texts of a key together, by the merged sketches.

    Merging takes place in each task before rows meet by key, and again after,
    so a key costs a task one sketch for each task before it.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Sketch] = {}
        for batch in batches:
            for *key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if text is not None:
                    own, at = Sketch.parse(text), tuple(key)
                    held[at] = held[at].merged(own) if at in held else own
        columns = [[*c] for c in zip(*held, strict=True)] or [[] for _ in keys]
        yield pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(columns, schema, strict=False)), pa.array([s.text() for s in held.values()], pa.string())], names=[*keys, column])

    from pyspark.sql.pandas.types import to_arrow_schema

    own = rows.select(*keys, F.col(column).cast("string").alias(column))
    schema = to_arrow_schema(own.schema)
    return own.mapInArrow(first, own.schema).repartition(*keys).mapInArrow(first, own.schema)


def _key(id_: Column, hash_: Column) -> Column:
    return F.struct(id_.isNotNull().alias("has"), F.coalesce(id_, F.lit(0)).alias("id"), hash_.alias("h"))


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, late, id, text): each row in the part of its range of ids, sorted within it, and behind them (``late``) the first row of the next part.

    Rows of one id are in the order of a hash of their text, rows without an id
    come first.  The part after the last is the first one.  So a part alone
    tells what comes after each of its rows.  Bounds are keys of a bounded
    sample, of about ``SAMPLED`` a range; ranges depend on ids and texts alone.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("key", _key(F.col("id"), F.xxhash64("text")))
    keys = source.select("key")
    every = max(1, docs.count() // (parts * SAMPLED))
    some = keys.where(F.pmod(F.xxhash64("key.has", "key.id", "key.h"), F.lit(every)) == 0).distinct().agg(F.array_sort(F.collect_list("key")).alias("some"))
    # one row; the least of all keys begins the first part
    bounds = some.crossJoin(keys.agg(F.min("key").alias("least"))).select(
        F.array_sort(
            F.array_distinct(F.array_append(F.transform(F.sequence(F.lit(1), F.lit(parts - 1)) if parts > 1 else F.array().cast("array<int>"), lambda k: F.get("some", F.floor(k * F.size("some") / parts).cast("int"))), F.col("least")))
        ).alias("bounds")
    ).select(F.filter("bounds", lambda b: b.isNotNull()).alias("bounds"))
    placed = source.crossJoin(F.broadcast(bounds)).withColumn("part", _last_not_above(F.col("bounds"), F.col("key")))
    first = F.element_at("bounds", F.col("part") + 1) == F.col("key")
    before = F.pmod(F.col("part") - 1, F.size("bounds"))
    own = F.struct("part", F.lit(False).alias("late"))
    also = F.struct(before.alias("part"), F.lit(True).alias("late"))
    dealt = placed.select("id", "text", F.col("key.h").alias("h"), F.explode(F.when(first, F.array(own, also)).otherwise(F.array(own))).alias("to"))
    dealt = dealt.select("to.part", "to.late", "id", "h", "text")
    return dealt.repartitionById(parts, "part").sortWithinPartitions("part", "late", F.asc_nulls_first("id"), "h").drop("h")


def _last_not_above(bounds: Column, key: Column) -> Column:
    """The place, from 0, of the last of the sorted bounds that isn't above the key; the first one isn't."""
    span = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        below = F.get(bounds, mid) <= key
        return F.when(s["hi"] - s["lo"] <= 1, s).when(below, F.struct(mid.alias("lo"), s["hi"].alias("hi"))).otherwise(F.struct(s["lo"].alias("lo"), mid.alias("hi")))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(bounds) + 1)).cast("int"))
    return F.aggregate(steps, span, halve, lambda s: s["lo"])


_WITH_NEXT = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, in_edited double, in_next double"


def _paired(fraction: float, least: int):
    """Rows of ``in_order`` to those of ``edited``; a row waits for the one behind it."""

    def finish(rows: list[tuple[int | None, str, Sketch, str, Sketch]]) -> pa.RecordBatch:
        edited = [text[: len(text) - len(text) // 2] + after[: len(text) // 2] for _, text, _, after, _ in rows]
        theirs = sketched(pa.array(edited, pa.large_string()), fraction, least)
        to_edited = [own.compared(e) for (_, _, own, _, _), e in zip(rows, theirs, strict=True)]
        to_next = [own.compared(n) for _, _, own, _, n in rows]
        columns = [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([len(r[1]) for r in rows], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
            pa.array([r[2].text() for r in rows], pa.string()),
            pa.array([e.text() for e in theirs], pa.string()),
            *(pa.array([x[k] for x in found], pa.float64()) for k, found in ((0, to_edited), (0, to_next), (1, to_edited), (1, to_next))),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _WITH_NEXT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            _, off = tokens.buffers(batch.column(3))
            for lo, hi in tokens.chunks(off):
                part, late, ids, texts = (batch.column(k).slice(lo, hi - lo) for k in range(4))
                ready = []
                for now in zip(part.to_pylist(), late.to_pylist(), ids.to_pylist(), texts.to_pylist(), sketched(texts, fraction, least), strict=True):
                    if held is not None and held[0] == now[0] and not held[1]:
                        ready.append((*held[2:], *now[3:]))
                    held = now
                if ready:
                    yield finish(ready)

    return run


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fraction: float = FRACTION, least: int = LEAST) -> DataFrame:
    """Each row's id, n_chars, fingerprint, and how like it is to the next row and to its own text with the next one's beginning as its end.

    The edited text is the text without its last floor(n_chars / 2) code points,
    and with the first as many (or all) of the next text; next is by ascending
    id, after the last the first, in the order of ``in_order``, so that a single
    row is its own next.  near_* estimate Jaccard similarities, in_* how much of
    the row's own set the other holds.  A null text counts as empty; equal texts
    have equal fingerprints; repeated rows stand for themselves; an empty table
    gives an empty result.  Other columns are not read.
    """
    found = in_order(docs, id_col, text_col).mapInArrow(_paired(fraction, least), _WITH_NEXT)
    return found.withColumnRenamed("id", id_col)
