"""Log-probabilities of texts under a weighted backoff automaton of smoothed n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.llm import packed, tokens
from tallyfold.llm.store import Store

#: Occurrences that the shorter context is worth beside those of a word's or a pair's own arcs.
PRIORS = (1000.0, 4.0)
#: What each token's count is raised by in the shortest context, which knows no history.
RAISED = 0.1
#: Bytes of text in a part; a longer text is a part by itself.
PART_BYTES = 8 << 20
#: Tokens of a text that are walked in one go; longer texts are walked in segments, side by side.
SEGMENT = 512
#: The end of a text, as a token.
END = np.uint64(0x454E442D4F462D54)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def with_end(w: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all documents, each followed by the end, and where each begins."""
    return np.insert(w.hash, w.first[1:], END), w.first + np.arange(len(w.first))


@dataclass
class Part:
    """Tokens of some texts: ``ids`` are places in ``words`` (sorted hashes), text d is ``first[d]:first[d + 1]``."""

    words: np.ndarray
    ids: np.ndarray
    first: np.ndarray
    learned: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Part:
        learn = np.array(row["learn"], bool)
        first = np.frombuffer(row["first"], np.int64)
        words = packed.unpack(row["words"], row["types"])
        return cls(words, packed.from_planes(packed.zstd(row["ids"], 4 * row["tokens"]), "i4"), first, np.repeat(learn, np.diff(first)))

    def __post_init__(self):
        place = np.arange(len(self.ids)) - np.repeat(self.first[:-1], np.diff(self.first))
        self.two, self.three = place >= 1, place >= 2

    def counts(self) -> np.ndarray:
        """Of each word, how often the part teaches it."""
        return np.bincount(self.ids[self.learned], minlength=len(self.words))

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each token, the keys of the pair and of the triple of words that end in it."""
        own = self.words[self.ids]
        pair = tokens.mix64(np.concatenate([np.zeros(1, np.uint64), own[:-1]]) * _BASE + own)
        return pair, tokens.mix64(np.concatenate([np.zeros(1, np.uint64), pair[:-1]]) * _BASE + tokens.mix64(own + np.uint64(3)))

    def grams(self, key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of the tokens ``at``, how often the part teaches each, and which each token has (the others: any)."""
        found, which = np.unique(key[at], return_inverse=True)
        place = np.zeros(len(key), np.int64)
        place[at] = which
        return found, np.bincount(which[self.learned[at]], minlength=len(found)), place


def _parts(part_bytes: int):
    """Rows (text, learn, row) to one row for each part: its number, its texts' rows, and what ``Part`` needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 33
        for batch in batches:
            buf, off = tokens.buffers(batch.column(0))
            for lo, hi in tokens.chunks(off, part_bytes):
                own, first = [], [np.zeros(1, np.int64)]
                for a, z in tokens.chunks(off[lo : hi + 1]):
                    hashes, begin = with_end(tokens.words(buf, off[lo + a : lo + z + 1]))
                    own.append(hashes)
                    first.append(begin[1:] + first[-1][-1])
                words, ids = np.unique(np.concatenate(own), return_inverse=True)
                first = np.concatenate(first)
                learn = batch.column(1).slice(lo, hi - lo)
                taught = int(np.diff(first)[learn.to_numpy(zero_copy_only=False)].sum())
                once = pa.array([0, hi - lo], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part]),
                        pa.array([len(ids)]),
                        pa.array([taught]),
                        pa.array([len(words)]),
                        pa.array([packed.pack(words)], pa.binary()),
                        pa.array([packed.zstd(packed.planes(ids.astype(np.int32)))], pa.binary()),
                        pa.array([first.tobytes()], pa.binary()),
                        pa.ListArray.from_arrays(once, learn),
                        pa.ListArray.from_arrays(once, batch.column(2).slice(lo, hi - lo)),
                    ],
                    names=["part", "tokens", "taught", "types", "words", "ids", "first", "learn", "rows"],
                )
                part += 1

    return run


def _ask(buckets: int):
    """A part's words and pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Part.of(row)
                yield packed.question(row["part"], 1, own.words, own.counts(), buckets)
                found, n, _ = own.grams(own.keys()[0], np.flatnonzero(own.two))
                yield packed.question(row["part"], 2, found, n, buckets)

    return run


def _triples(own: Part, answers: pa.Table, buckets: int):
    """Pairs and triples of a part: distinct keys, counts, place by token; of pairs all that is known, and which triples have to be asked for.

    A triple can stand in another part only if both its pairs do.
    """
    pair_key, triple_key = own.keys()
    found, n, pair = own.grams(pair_key, np.flatnonzero(own.two))
    n2, shared = packed.counted(found, n, answers, 2, buckets)
    shared = own.two & shared[pair] if len(found) else own.two
    at = np.flatnonzero(own.three)
    keys, n3, triple = own.grams(triple_key, at)
    open_ = np.zeros(len(keys), bool)
    open_[triple[at[shared[at] & shared[at - 1]]]] = True
    return n2, pair, keys, n3, triple, open_


def _ask_triples(buckets: int):
    def run(part: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in part.to_pylist():
            _, _, keys, n, _, open_ = _triples(Part.of(row), answers, buckets)
            out.append(packed.question(row["part"], 3, keys[open_], n[open_], buckets))
        return pa.Table.from_batches(out, out[0].schema if out else packed.question(0, 3, np.zeros(0, np.uint64), np.zeros(0), 1).schema)

    return run


@dataclass
class Automaton:
    """States, the arcs that leave them, and the failure arcs.

    State 0 is the empty context, the next ones are contexts of one word, the
    others of two; each context that was taught is a state.  An arc is found by
    ``state * words + word``; it has a log10 weight and the state that it leads
    to, the longest context of its words.  A word without an arc is looked for
    from the state that the failure arc leads to, at the failure arc's weight;
    the empty context has an arc for every word.
    """

    words: int
    arcs: np.ndarray
    weight: np.ndarray
    target: np.ndarray
    fail: np.ndarray
    fail_weight: np.ndarray

    @classmethod
    def of(cls, own: Part, n1: np.ndarray, pairs: tuple[np.ndarray, np.ndarray], triples: tuple[np.ndarray, np.ndarray], total: int, types: int, priors: tuple[float, float]) -> Automaton:
        """Of a part's words, pairs and triples, with their counts over all parts; pairs and triples as counts and, by token, which one ends there."""
        size = len(own.words)
        p1 = (n1 + RAISED) / (total + RAISED * (types + 1))
        known = n1 > 0
        of_word = np.where(known, np.cumsum(known), 0)

        n2, pair = pairs
        at = _where(len(n2), pair, own.two)
        u, v = own.ids[at - 1], own.ids[at]
        p2 = (n2 + priors[0] * p1[v]) / (n1[u] + priors[0])
        taught = n2 > 0
        of_pair = np.where(taught, known.sum() + np.cumsum(taught), of_word[v])

        n3, triple = triples
        to = _where(len(n3), triple, own.three)
        first, second = pair[to - 1], pair[to]
        p3 = (n3 + priors[1] * p2[second]) / (n2[first] + priors[1])
        some = n3 > 0

        arcs = np.concatenate([np.arange(size), of_word[u[taught]] * size + v[taught], of_pair[first[some]] * size + own.ids[to[some]]])
        weight = np.log10(np.concatenate([p1, p2[taught], p3[some]]))
        target = np.concatenate([of_word, of_pair[taught], of_pair[second[some]]])
        order = np.argsort(arcs)
        fail = np.concatenate([np.zeros(1 + known.sum(), np.int64), of_word[v[taught]]])
        lost = np.concatenate([[1.0], priors[0] / (n1[known] + priors[0]), priors[1] / (n2[taught] + priors[1])])
        return cls(size, arcs[order], weight[order], target[order], fail, np.log10(lost))

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From states, by words: the log10 weights of the ways, and where they lead."""
        state, spent = state.copy(), np.zeros(len(state))
        arc = np.empty(len(state), np.int64)
        open_ = np.arange(len(state))
        while len(open_):
            key = state[open_] * self.words + word[open_]
            at = np.searchsorted(self.arcs, key)
            hit = self.arcs[np.minimum(at, len(self.arcs) - 1)] == key
            arc[open_[hit]] = at[hit]
            open_ = open_[~hit]
            spent[open_] += self.fail_weight[state[open_]]
            state[open_] = self.fail[state[open_]]
        return spent + self.weight[arc], self.target[arc]

    def walk(self, ids: np.ndarray, first: np.ndarray, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
        """From left to right through texts, the state carried: of each token the log10 probability, and the state after it.

        Texts go side by side, long ones in segments.  A segment sets out two
        tokens before its first, as no state holds more; so it begins in the
        state in which the one before it ends.
        """
        lengths = np.diff(first)
        pieces = -(-lengths // segment)
        text = np.repeat(np.arange(len(lengths)), pieces)
        begin = first[text] + segment * (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        end = np.minimum(begin + segment, first[text + 1])
        at = np.maximum(begin - 2, first[text])
        order = np.argsort(at - end, kind="stable")
        begin, end, at = begin[order], end[order], at[order]
        scores, states = np.empty(len(ids)), np.empty(len(ids), np.int64)
        state = np.zeros(len(at), np.int64)
        left = len(at)
        while left:
            score, state = self.step(state[:left], ids[at[:left]])
            inside = at[:left] >= begin[:left]
            scores[at[:left][inside]], states[at[:left][inside]] = score[inside], state[inside]
            at[:left] += 1
            while left and at[left - 1] >= end[left - 1]:  # the shortest are last
                left -= 1
        return scores, states


def _where(n: int, which: np.ndarray, has: np.ndarray) -> np.ndarray:
    """For each of n n-grams a token that ends it."""
    out = np.zeros(n, np.int64)
    at = np.flatnonzero(has)
    out[which[at]] = at
    return out


def _walk(buckets: int, total: int, types: int, priors: tuple[float, float]):
    """Sums over each text's tokens; ``total`` and ``types`` are of all that was taught."""

    def run(part: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        rows = part.column("rows").combine_chunks()
        for k, row in enumerate(part.drop_columns(["rows"]).to_pylist()):
            own = Part.of(row)
            n1 = packed.counted(own.words, own.counts(), answers, 1, buckets)[0].astype(float)
            n2, pair, keys, n3, triple, open_ = _triples(own, answers, buckets)
            n3 = n3.astype(np.int64)
            n3[open_] = packed.counted(keys[open_], n3[open_], answers, 3, buckets)[0]
            automaton = Automaton.of(own, n1, (n2.astype(float), pair), (n3.astype(float), triple), total, types, priors)
            scores, _ = automaton.walk(own.ids, own.first)
            each = n1[own.ids]
            base = np.log10((each + RAISED) / (total + RAISED * (types + 1)))
            sums = [np.add.reduceat(x, own.first[:-1]) for x in ((each > 0).astype(np.int64), base, scores)]
            cols = [rows.slice(k, 1).flatten(), pa.array(np.diff(own.first)), *map(pa.array, sums)]
            out.append(pa.table(cols, names=["row", "n_tokens", "n_known", "base_score", "score"]))
        return pa.concat_tables(out)

    return run


def score(
    docs: DataFrame,
    learn: Column | bool = True,
    store: Store | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
    priors: tuple[float, float] = PRIORS,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Each row's id, ``carry`` columns, n_tokens, n_known, train_tokens, base_score, score, under what the rows of ``learn`` teach.

    All words, pairs and triples of words of the rows of ``learn`` are arcs of an
    ``Automaton``, however rare; each text is one way through it.  With c the count of a context, n that of an arc and q the
    probability in the context without its first word, an arc's probability is
    (n + prior * q) / (c + prior); the shortest context adds 0.1 to each count
    and has one more token for all that is unknown.  So each state's
    probabilities add up to one.  ``score`` is the log10 probability of all
    tokens, the end of the text included, ``base_score`` that in the shortest
    context alone.

    Texts go in parts of some MB.  Each asks for the counts of its n-grams once
    over all parts, of triples only for those whose pairs other parts have too,
    as the others can't stand elsewhere; so no table of the model is held in one
    place.  A null or empty text is the end alone.  Rows are scored by
    themselves, also if they share an id or have none.  Texts that nothing was
    learned from have only unknown tokens.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    store = store or Store(spark, "lm")
    learn = F.lit(learn) if isinstance(learn, bool) else learn
    source = docs.select(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
        F.struct(F.col(id_col).cast("long").alias(id_col), *carry).alias("row"),
    )
    fields = "part long, tokens long, taught long, types long, words binary, ids binary, first binary, learn array<boolean>"
    rows = T.StructType([*T._parse_datatype_string(fields).fields, T.StructField("rows", T.ArrayType(source.schema["row"].dataType))])
    parts = store.put(source.mapInArrow(_parts(part_bytes), rows), "parts")
    size = parts.agg(F.sum("tokens"), F.sum("taught")).first()
    most, total = int(size[0] or 0), int(size[1] or 0)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-most // packed.BUCKET_KEYS))
    known = store.put(packed.settle(parts.drop("rows").mapInArrow(_ask(buckets), packed.ASKED)), "answers")
    types = int(known.where("part < 0 AND size = 1").agg(F.sum("m")).first()[0] or 0)
    known = known.where("part >= 0")
    asked = parts.drop("rows").groupBy("part").cogroup(known.where("size = 2").groupBy("part")).applyInArrow(_ask_triples(buckets), packed.ASKED)
    more = store.put(packed.settle(asked), "triples").where("part >= 0")
    out = T.StructType([T.StructField("row", parts.schema["rows"].dataType.elementType), *T._parse_datatype_string("n_tokens long, n_known long, base_score double, score double").fields])
    store.free()
    walked = parts.groupBy("part").cogroup(known.union(more).groupBy("part")).applyInArrow(_walk(buckets, total, types, priors), out)
    return walked.select(f"row.{id_col}", *(f"row.{c}" for c in carry), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
