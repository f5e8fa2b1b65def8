"""Good and bad lines, and document quality, by a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.llm import crf, labelled, tokens

#: What is measured of a line, and the cutoffs between its grades.
CUTS = {
    "words": (1, 2, 4, 8, 16, 32, 64, 128),
    "chars_per_word": (2, 3, 4, 5, 6, 7, 8, 10, 14),
    "upper": (0.02, 0.05, 0.1, 0.25, 0.5, 0.9),
    "digits": (0.01, 0.03, 0.1, 0.3),
    "marks": (0.01, 0.03, 0.06, 0.1, 0.2, 0.4),
    "pipes": (0.005, 0.02, 0.05, 0.1),
    "shouts": (0.005, 0.02, 0.05, 0.1),
    "stops": (0.002, 0.01, 0.02, 0.04, 0.08),
    "distinct": (0.1, 0.25, 0.5, 0.7, 0.85, 0.95, 0.999),
    "repeated": (0.5,),
}
_OFFSET = np.concatenate([[0], np.cumsum([len(c) + 1 for c in CUTS.values()])])
GRADES = int(_OFFSET[-1])


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER, _DIGIT = _class(bytes(range(65, 91))), _class(b"0123456789")
_MARK, _PIPE, _SHOUT, _STOP = _class(b"#*$%&<>@^~=_+{}[]\\/"), _class(b"|"), _class(b"!?"), _class(b".,;:")
_REAL = _class(bytes(x for x in range(256) if x not in (9, 10, 11, 12, 13, 32) and x & 0xC0 != 0x80))


@dataclass
class Lines:
    """Lines with a word: grades of each, its code points without space, and where each document's begin."""

    grades: np.ndarray
    chars: np.ndarray
    first: np.ndarray


def lines(buf: np.ndarray, off: np.ndarray) -> Lines:
    """Lines (split at \\n) of the documents between ``off[0]`` and ``off[-1]``; those without a word are left out."""
    w = tokens.words(buf, off, lower=False)
    b = w.buf
    cut = np.union1d(np.flatnonzero(b == 10), w.off[1:-1])
    line_of = np.searchsorted(cut, w.start, side="right")
    doc_of = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    lead = np.flatnonzero(np.concatenate([[True], (line_of[1:] != line_of[:-1]) | (doc_of[1:] != doc_of[:-1])])) if len(line_of) else np.zeros(0, np.int64)
    if not len(lead):
        return Lines(np.zeros((0, len(CUTS)), np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64))
    count = np.diff(np.append(lead, len(line_of)))
    begin = w.start[lead]
    doc = doc_of[lead]

    def total(kind: np.ndarray) -> np.ndarray:
        return np.add.reduceat(kind[b].astype(np.int64), begin)

    real = np.maximum(1, total(_REAL))
    own = np.repeat(np.arange(len(lead)), count)
    order = np.lexsort((w.hash, own))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (own[order][1:] != own[order][:-1])
    distinct = np.bincount(own[order][fresh], minlength=len(lead)) / count
    place = np.arange(len(own)) - np.repeat(lead, count)
    text = np.add.reduceat(w.hash * (place.astype(np.uint64) * np.uint64(2) + np.uint64(0x9E3779B1)), lead)
    order = np.lexsort((np.arange(len(lead)), text, doc))
    again = np.zeros(len(lead))
    again[order[1:]] = (text[order][1:] == text[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    values = {
        "words": count,
        "chars_per_word": real / count,
        "upper": total(_UPPER) / real,
        "digits": total(_DIGIT) / real,
        "marks": total(_MARK) / real,
        "pipes": total(_PIPE) / real,
        "shouts": total(_SHOUT) / real,
        "stops": total(_STOP) / real,
        "distinct": distinct,
        "repeated": again,
    }
    grades = np.column_stack([np.searchsorted(CUTS[k], values[k], side="right") + o for k, o in zip(CUTS, _OFFSET, strict=False)])
    return Lines(grades, real, np.searchsorted(doc, np.arange(len(off))))


def features(x: Lines) -> np.ndarray:
    """A line's own grades, those of the line before and of the line after, and a constant."""
    n = len(x.grades)
    before, after = np.full_like(x.grades, -1), np.full_like(x.grades, -1)
    before[1:], after[:-1] = x.grades[:-1] + GRADES, x.grades[1:] + 2 * GRADES
    some = np.diff(x.first) > 0
    before[x.first[:-1][some]] = -1
    after[x.first[1:][some] - 1] = -1
    return np.column_stack([x.grades, before, after, np.full(n, 3 * GRADES)])


SIZE = 3 * GRADES + 1


def summed(p: np.ndarray, x: Lines) -> np.ndarray:
    """Of each document: log-odds of its good share by length, the share itself, its worst line, whether it has any."""
    n = np.diff(x.first)
    some = np.flatnonzero(n)
    share, worst = np.full(len(n), 0.5), np.full(len(n), 0.5)
    if len(some):
        share[some] = np.add.reduceat(p * x.chars, x.first[some]) / np.add.reduceat(x.chars, x.first[some])
        worst[some] = np.minimum.reduceat(p, x.first[some])
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return np.column_stack([np.log(share / (1 - share)), share, worst, n > 0])


@dataclass
class Model:
    field: crf.Field
    beta: np.ndarray


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> Model:
    """A field over lines; lines are tagged by their document's label, then documents by their lines' marginals."""
    number = labelled.counts(labels, label_col)
    ys, parts, chars, sizes = [], [], [], []
    for y, text in labelled.sample(docs, labels, label_col):
        x = lines(*tokens.buffers(pa.array([text], pa.string())))
        ys.append(y)
        parts.append(x.grades)
        chars.append(x.chars)
        sizes.append(len(x.chars))
    model = Model(crf.Field(np.zeros(SIZE), np.zeros((2, 2)), np.zeros(2)), np.zeros(5))
    if not ys:
        return model
    y = np.array(ys, int)
    x = Lines(np.concatenate(parts), np.concatenate(chars), np.concatenate([[0], np.cumsum(sizes)]))
    tags = np.repeat(y, sizes)
    if len(tags):
        model.field = crf.train(features(x), tags, x.first, SIZE, ridge=2.0)
    n1, n0 = max(1, int((y == 1).sum())), max(1, int((y == 0).sum()))
    weights = np.where(y == 1, number[1] / n1, number[0] / n0)
    model.beta = crf.logistic(summed(model.field.tag(features(x), x.first), x), y, weights)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), marginals: bool = False) -> DataFrame:
    """Each row's id, ``carry`` columns and score (0 to 1, higher: better); with ``marginals`` each line's probability of being good.

    Lines without a word have no marginal.  A null or empty text has the score
    of a text in which nothing was found.  Rows are scored by themselves.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(text_col).cast("string").alias("__text"), F.col(id_col).cast("long").alias(id_col), *carry)
    fields = T.StructType([*source.schema.fields[1:], T.StructField("score", T.DoubleType())] + [T.StructField("line_p", T.ArrayType(T.DoubleType()))] * marginals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            buf, off = tokens.buffers(batch.column(0))
            for lo, hi in tokens.chunks(off):
                x = lines(buf, off[lo : hi + 1])
                p = own.field.tag(features(x), x.first) if len(x.chars) else np.zeros(0)
                columns = [c.slice(lo, hi - lo) for c in batch.columns[1:]] + [pa.array(crf.probability(summed(p, x), own.beta))]
                names = [id_col, *carry, "score"]
                if marginals:
                    columns.append(pa.ListArray.from_arrays(pa.array(x.first.astype(np.int32)), pa.array(p)))
                    names.append("line_p")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(run, fields)
