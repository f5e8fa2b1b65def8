"""Toxic spans and document scores by a linear-chain conditional random field over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import crf, labelled, tokens

#: Words and beginnings of words with a weight of their own, and among them the markers whose neighbours get one too.
VOCABULARY, MARKERS = 8192, 1024
#: Bytes of the beginnings, which longer words share with other forms of themselves.
BEGINNINGS = (4, 5, 6)
#: How sure it has to be that a marker stands in toxic texts more often than in others: the exponent of a tail bound.
EVIDENCE = 20.0
#: Words of a training sequence.  Those around a marker all count, of the others every ``SPARSE``-th.
SEGMENT, SPARSE = 32, 16
#: Words whose marginal is at least this belong to a reported span.
SPAN = 0.5


def units(w: tokens.Words) -> np.ndarray:
    """Hashes of each word and of its beginnings; 0 where the word is too short for one."""
    out = np.zeros((len(w.hash), 1 + len(BEGINNINGS)), np.uint64)
    out[:, 0] = w.hash
    length = w.end - w.start
    for k, size in enumerate(BEGINNINGS, 1):
        some = np.flatnonzero(length > size)
        h = np.full(len(some), size, np.uint64)
        for j in range(size):
            h = h * np.uint64(0x100000001B3) + w.buf[w.start[some] + j]
        out[some, k] = tokens.mix64(h)
    return out


@dataclass
class Model:
    vocabulary: np.ndarray
    marker: np.ndarray
    field: crf.Field
    beta: np.ndarray

    def marked(self, places: np.ndarray) -> np.ndarray:
        return np.append(self.marker, False)[places].any(axis=1)

    def features(self, places: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of each word: its units, whether a marker is before it or after it, a constant."""
        size, n = len(self.vocabulary), len(places)
        marked = self.marked(places)
        before, after = np.full(n, -1), np.full(n, -1)
        before[1:][marked[:-1]] = size
        after[:-1][marked[1:]] = size + 1
        some = np.diff(first) > 0
        before[first[:-1][some]] = -1
        after[first[1:][some] - 1] = -1
        return np.column_stack([places, before, after, np.full(n, size + 2)])

    def marginals(self, w: tokens.Words, index: tokens.Index) -> np.ndarray:
        if not len(w.hash):
            return np.zeros(0)
        return self.field.tag(self.features(index.find(units(w).ravel()).reshape(len(w.hash), -1), w.first), w.first)


def _summed(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each document: expected toxic words (log), the largest marginal, toxic words a word."""
    n = np.diff(first)
    filled = np.flatnonzero(n)
    total, top = np.zeros(len(n)), np.zeros(len(n))
    if len(filled):
        total[filled] = np.add.reduceat(p, first[filled])
        top[filled] = np.maximum.reduceat(p, first[filled])
    return np.column_stack([np.log1p(total), top, total / np.maximum(n, 1)])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> Model:
    """A field over words, from labelled documents.

    Which words of a toxic document are toxic isn't labelled, so words are
    tagged first: markers are words, or beginnings of words, that toxic documents
    hold far more often than chance would have it, near copies counting once.  The field learns from
    those tags; what its marginals say of a document is then weighed against
    the documents' own labels.
    """
    number = labelled.counts(labels, label_col)
    ys, found = [], []
    for y, text in labelled.sample(docs, labels, label_col):
        for _, _, w in tokens.text_chunks(pa.array([text], pa.string())):
            ys.append(y)
            found.append(units(w))
    y = np.array(ys, int)
    first = np.concatenate([[0], np.cumsum([len(h) for h in found])]).astype(np.int64)
    flat = np.concatenate([np.zeros((0, 1 + len(BEGINNINGS)), np.uint64), *found])
    names, at = np.unique(flat, return_inverse=True)
    doc = np.repeat(np.arange(len(y)), np.diff(first))
    size = max(1, len(names))
    own = np.unique((doc[:, None] * size + at.reshape(flat.shape)).ravel())
    d, k = own // size, own % size
    n1, n0 = max(1, int((y == 1).sum())), max(1, int((y == 0).sum()))
    pos = np.bincount(k[y[d] == 1], minlength=size).astype(float)
    neg = np.bincount(k[y[d] == 0], minlength=size).astype(float)
    if len(names) and names[0] == 0:
        pos[0] = neg[0] = 0
    odds = np.log((pos + 0.1) / n1) - np.log((neg + 0.1) / n0)
    share, q = (pos + 1e-9) / (pos + neg + 2e-9), n1 / (n1 + n0)
    bound = (pos + neg) * (share * np.log(share / q) + (1 - share) * np.log((1 - share) / (1 - q)))
    evidence = np.where(odds > 2, bound, 0)
    best = np.argsort(-evidence, kind="stable")[:MARKERS]
    best = best[evidence[best] >= EVIDENCE]
    strong = np.argsort(-bound, kind="stable")[: VOCABULARY - len(best)]
    chosen = np.unique(np.concatenate([best, strong[bound[strong] >= 3]])).astype(int)
    chosen = chosen[names[chosen] != 0] if len(names) else chosen[:0]
    vocabulary = names[chosen]
    width = len(vocabulary) + 3
    model = Model(vocabulary, np.isin(chosen, best), crf.Field(np.zeros(width), np.zeros((2, 2)), np.zeros(2)), np.zeros(4))
    places = tokens.Index(vocabulary).find(flat.ravel()).reshape(flat.shape)
    features = model.features(places, first)
    if len(flat):
        marked = model.marked(places)
        cuts = np.unique(np.concatenate([np.arange(a, b, SEGMENT) for a, b in zip(first, first[1:], strict=False)] + [first[-1:]]))
        near = np.add.reduceat(marked.astype(int), cuts[:-1]) > 0
        near |= np.arange(len(near)) % SPARSE == 0
        used = np.repeat(near, np.diff(cuts))
        heads = np.concatenate([[0], np.cumsum(np.diff(cuts)[near])])
        tags = marked & (y[doc] == 1)
        model.field = crf.train(features[used], tags[used].astype(int), heads, width)
    weights = np.where(y == 1, number[1] / n1, number[0] / n0)
    if len(y):
        model.beta = crf.logistic(_summed(model.field.tag(features, first), first), y, weights)
    return model


def tag(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", spans: bool = True) -> DataFrame:
    """Each row's id, score (0 to 1), toxic_words (expected) and, with ``spans``, the offending spans.

    A span is (begin, end, p): code points of the text, end excluded, and the
    largest marginal of its words.  A null or empty text has no spans and the
    score of a text in which nothing was found.  Rows are tagged by themselves.
    """
    fields = f"{id_col} long, score double, toxic_words double" + ", spans array<struct<begin: long, end: long, p: double>>" * spans
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        index = tokens.Index(own.vocabulary)
        for batch in batches:
            for lo, hi, w in tokens.text_chunks(batch.column(1)):
                p = own.marginals(w, index)
                sums = _summed(p, w.first)
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(crf.probability(sums, own.beta)), pa.array(np.expm1(sums[:, 0]))]
                if spans:
                    columns.append(_spans(p, w))
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "score", "toxic_words", "spans"][: len(columns)])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, fields)


def _spans(p: np.ndarray, w: tokens.Words) -> pa.Array:
    kind = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])
    hit = np.flatnonzero(p >= SPAN)
    doc = np.searchsorted(w.first, hit, side="right") - 1
    lead = np.ones(len(hit), bool)
    lead[1:] = (np.diff(hit) > 1) | (doc[1:] != doc[:-1])
    begins = np.flatnonzero(lead)
    ends = np.append(begins[1:], len(hit))[: len(begins)] - 1
    points = np.concatenate([[0], np.cumsum((w.buf & 0xC0) != 0x80)])
    of = doc[begins] if len(begins) else np.zeros(0, int)
    base = points[w.off[of]]
    begin, end = points[w.start[hit[begins]]] - base, points[w.end[hit[ends]]] - base
    top = np.maximum.reduceat(p[hit], begins) if len(begins) else np.zeros(0)
    off = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(w.first) - 1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.StructArray.from_arrays([pa.array(begin), pa.array(end), pa.array(top)], fields=list(kind)))
