"""Passages that repeat across documents: paragraphs, exactly or nearly, by MinHash banding, and verbatim runs of words; all but the first of each are cut.

Paragraphs are bounded by what stands in them, not by lines, so a passage has
the same ones in whatever lines, and behind whatever words, it stands.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.llm import minhash, packed, tokens
from tallyfold.llm.store import Store

#: A paragraph begins at the word whose hash, with that of the next one, is least among those of so many words on either side.
AROUND = 32
#: Words from which a paragraph is a passage; only the first and last of a document can be shorter.
LEAST_WORDS = 32
#: Words of a window, and consecutive windows of which the one of the smallest hash is a mark.  Each run of at least
#: WINDOW + WITHIN - 1 = 47 words that two documents share holds a mark of both.
WINDOW, WITHIN = 32, 16
#: Words on either side of a mark up to which a match is followed past it.
REACH = 32
#: Bands of minima, and minima in a band: 0.9977 of pairs at a similarity of 0.75 meet in a band, 0.99994 of those at 0.85.
BANDS, ROWS = 16, 4
#: Bytes of text in a part; a longer text is a part by itself.
PART_BYTES = 8 << 20


def paragraphs(w: tokens.Words) -> np.ndarray:
    """The first words of all paragraphs of consecutive documents, and the number of words."""
    n = len(w.hash)
    counts = np.diff(w.first)
    if not n:
        return np.zeros(1, np.int64)
    two = tokens.mix64(w.hash * tokens._BASE + np.append(w.hash[1:], np.uint64(0)))
    last = w.first[1:][counts > 0] - 1
    two[last] = ~np.uint64(0)
    # documents lie AROUND places apart, so that none looks at another's words
    place = np.arange(n) + AROUND * (1 + np.repeat(np.arange(len(counts)), counts))
    wide = np.full(n + AROUND * (len(counts) + 2), ~np.uint64(0))
    wide[place] = two
    least, width = wide, 1
    while width < AROUND:
        step = min(width, AROUND - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    begins = (two < least[place - AROUND]) & (two <= least[place + 1])
    begins[w.first[:-1][counts > 0]] = True
    return np.append(np.flatnonzero(begins), n)


def _names(w: tokens.Words) -> np.ndarray:
    """A 64-bit name of each of ``w``'s word sequences, none of which is empty."""
    counts = np.diff(w.first)
    place = np.arange(len(w.hash)) - np.repeat(w.first[:-1], counts)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(counts.max(initial=1)), tokens._BASE)]), dtype=np.uint64)
    total = np.add.reduceat(w.hash * power[place], w.first[:-1]) if len(counts) else np.zeros(0, np.uint64)
    return tokens.mix64(total ^ counts.astype(np.uint64)).view(np.int64)


def _marks(w: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first words of the marks of each document: the least window of any WITHIN in a row, or of all if they are fewer."""
    run, n, power = w.hash, 1, int(tokens._BASE)
    while n < WINDOW:  # twice as long each time
        if len(run) <= n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        run = run[:-n] * np.uint64(power) + run[n:]
        n, power = 2 * n, power * power & 0xFFFFFFFFFFFFFFFF
    run = tokens.mix64(run)
    begin, windows = w.first[:-1], np.maximum(np.diff(w.first) - WINDOW + 1, 0)
    found = []
    if len(run) >= WITHIN:
        left = np.zeros(len(run), np.int64)  # windows of the same document from here on
        some = np.flatnonzero(windows)
        here = np.repeat(begin[some] - (np.cumsum(windows[some]) - windows[some]), windows[some]) + np.arange(windows[some].sum())
        left[here] = np.repeat(begin[some] + windows[some], windows[some]) - here
        full = np.flatnonzero(left >= WITHIN)
        grid = np.lib.stride_tricks.sliding_window_view(run, WITHIN)
        for lo in range(0, len(full), 1 << 18):
            part = full[lo : lo + (1 << 18)]
            found.append(np.unique(part + grid[part].argmin(axis=1)))
    for d in np.flatnonzero((windows > 0) & (windows < WITHIN)):
        a = int(begin[d])
        found.append(np.array([a + int(run[a : a + int(windows[d])].argmin())]))
    at = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return run[at], at


def _around(w: tokens.Words, d: int, at: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of up to REACH words before a window of document ``d``, the nearest first, and of up to as many after it."""
    a, z = int(w.first[d]), int(w.first[d + 1])
    here = a + at
    return w.hash[max(a, here - REACH) : here][::-1], w.hash[here + WINDOW : min(z, here + WINDOW + REACH)]


def _merged(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that touch or overlap as one, in order."""
    spans: list[tuple[int, int]] = []
    for a, z in sorted(found):
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(z, spans[-1][1]))
        else:
            spans.append((a, z))
    return spans


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (id, h, matches), the matches from which a span of them may go on: those near its ends."""
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
    for batch in batches:
        out: list[tuple[int, ...]] = []
        for row, h, matches in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            spans = _merged([(m["at"], m["at"] + WINDOW) for m in matches])
            k = 0
            for m in sorted(matches, key=lambda m: m["at"]):
                while m["at"] >= spans[k][1]:
                    k += 1
                if m["at"] - spans[k][0] <= WITHIN or spans[k][1] - m["at"] - WINDOW <= WITHIN:
                    out.append((row, h, m["at"], m["first_id"], m["first_h"], m["first_at"]))
        cols = list(zip(*out, strict=True)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["id", "h", "at", "first_id", "first_h", "first_at"])


def _agree(x: np.ndarray, y: np.ndarray) -> int:
    """How many leading items are the same."""
    n = min(len(x), len(y))
    other = np.flatnonzero(x[:n] != y[:n])
    return int(other[0]) if len(other) else n


def _without(text: bytes, start: np.ndarray, end: np.ndarray, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without ranges of its words (byte offsets start, end); what is left is joined by the line break or space that was there."""
    out, last = b"", 0
    for a, z in spans:
        out += text[last : int(start[a])]
        last = int(end[z - 1])
        rest = text[last:]
        gap = rest[: len(rest) - len(rest.lstrip(b"\x20\t\n\x0b\x0c\r"))]
        kept = out.rstrip(b"\x20\t\n\x0b\x0c\r")
        own = out[len(kept) :]
        if not kept or len(gap) == len(rest):  # at an end of the text
            last += len(gap) if not kept else 0
            out = kept
        else:
            # a line break on either side stays one
            out = kept + (own if b"\n" in own else gap or own)
            last += len(gap)
    return out + text[last:]


#: A part: its rows (id, h), paragraphs (row, first word, past the last, name), what belongs to each name (text, band keys), marks (row, first word, key).
_PART = (
    "part long, ids array<long>, hs array<long>, p_row array<int>, p_from array<int>, p_to array<int>, p_name array<long>, "
    "names array<long>, texts array<string>, bands binary, m_row array<int>, m_at array<int>, marks binary"
)


def _sketch(least: int, part_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 33
        for batch in batches:
            buf, off = tokens.buffers(batch.column(2))
            for lo, hi in tokens.chunks(off, part_bytes):
                rows: list[list[np.ndarray]] = [[], [], [], [], [], [], []]
                names, texts, bands = [], [], []
                seen: set[int] = set()
                for a, z in tokens.chunks(off[lo : hi + 1]):
                    w = tokens.words(buf, off[lo + a : lo + z + 1])
                    cuts = paragraphs(w)
                    size = np.diff(cuts)
                    use = np.flatnonzero(size >= least)
                    begin, end = cuts[:-1][use], cuts[1:][use]
                    doc = np.searchsorted(w.first, begin, side="right") - 1
                    keep = np.repeat(size >= least, size)
                    own = tokens.Words(w.hash[keep], w.start[keep], w.end[keep], np.concatenate([[0], np.cumsum(size[use])]), w.buf, w.off)
                    name = _names(own)
                    keys = minhash.band_keys(minhash.signatures(*tokens.shingles(own, minhash.SHINGLE), BANDS * ROWS), ROWS)
                    for k, x in enumerate(name.tolist()):
                        if x not in seen:
                            seen.add(x)
                            names.append(x)
                            texts.append(w.buf[int(w.start[begin[k]]) : int(w.end[end[k] - 1])].tobytes().decode("utf-8", "replace"))
                            bands.append(keys[k])
                    mark, at = _marks(w)
                    where = np.searchsorted(w.first, at, side="right") - 1
                    for held, x in zip(rows, (doc + a, begin - w.first[doc], end - w.first[doc], name, where + a, at - w.first[where], mark), strict=True):
                        held.append(x)
                p_row, p_from, p_to, p_name, m_row, m_at, marks = (np.concatenate(x) for x in rows)
                listed = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind) if not isinstance(x, pa.Array) else x)
                columns = [
                    pa.array([part]),
                    listed(batch.column(0).slice(lo, hi - lo), None),
                    listed(batch.column(1).slice(lo, hi - lo), None),
                    *(listed(x.astype(np.int32), pa.int32()) for x in (p_row, p_from, p_to)),
                    listed(p_name, pa.int64()),
                    listed(names, pa.int64()),
                    listed(texts, pa.string()),
                    pa.array([np.array(bands, np.uint64).tobytes()], pa.binary()),
                    *(listed(x.astype(np.int32), pa.int32()) for x in (m_row, m_at)),
                    pa.array([marks.tobytes()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _PART.split(", ")])
                part += 1

    return run


def _first_marks(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A part's distinct marks, how often and where first each stands, and of all marks, in order, which each is and its place."""
    marks, of = np.frombuffer(row["marks"], np.uint64), np.array(row["m_row"], np.int64)
    place = np.empty(len(marks), packed.PLACE)
    place["id"], place["h"] = np.array(row["ids"], np.int64)[of], np.array(row["hs"], np.int64)[of]
    place["at"] = row["m_at"]
    order = np.lexsort((place["at"], place["h"], place["id"], marks))
    place = place[order]
    keys, lead, which, n = np.unique(marks[order], return_index=True, return_inverse=True, return_counts=True)
    return keys, n, place[lead], which, place


def _ask(buckets: int):
    """A part's band keys (once for each name) and marks, with where they stand first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, n = np.unique(np.frombuffer(row["bands"], np.uint64), return_counts=True)
                yield packed.question(row["part"], 1, keys, n, buckets)
                keys, n, first, _, _ = _first_marks(row)
                yield packed.question(row["part"], 2, keys, n, buckets, first)

    return run


def _met(buckets: int):
    """What a part shares: (kind 1) names with the band keys that stand elsewhere too; (kind 2) marks that a document of a smaller id has first."""

    def run(part: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in part.to_pylist():
            keys, at, n = np.unique(np.frombuffer(row["bands"], np.uint64), return_inverse=True, return_counts=True)
            hit = ((packed.counted(keys, n, answers, 1, buckets)[1]) | (n > 1))[at].reshape(-1, BANDS)
            band = np.frombuffer(row["bands"], np.int64).reshape(-1, BANDS)
            some = np.flatnonzero(hit.any(axis=1))
            off = np.concatenate([[0], np.cumsum(hit[some].sum(axis=1))]).astype(np.int32)
            none = lambda kind, k=len(some): pa.nulls(k, kind)
            named = [
                pa.array(np.ones(len(some), np.int32)),
                pa.array(np.array(row["names"], np.int64)[some]),
                *(none(kind) for kind in 2 * (pa.int64(), pa.int64(), pa.int32())),
                pa.ListArray.from_arrays(pa.array(off), pa.array(band[some][hit[some]])),
            ]
            keys, _, first, which, place = _first_marks(row)
            first = packed.placed(keys, first, answers, 2, buckets)[which]
            here = place["id"] > first["id"]
            marked = [
                pa.array(np.full(int(here.sum()), 2, np.int32)),
                pa.nulls(int(here.sum()), pa.int64()),
                *(pa.array(np.ascontiguousarray(x[c][here])) for x in (place, first) for c in packed.PLACE.names),
                pa.nulls(int(here.sum()), pa.list_(pa.int64())),
            ]
            names = ["kind", "key", "id", "h", "at", "first_id", "first_h", "first_at", "bands"]
            out += [pa.table(x, names=names) for x in (named, marked)]
        return pa.concat_tables(out)

    return run


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, h, at, before, after) of rows (id, h, text, ats): the words around each of the windows asked for."""
    for batch in batches:
        wanted = batch.column(3).to_pylist()
        for lo, hi, w in tokens.text_chunks(batch.column(2)):
            row, ats, before, after = [], [], [], []
            for d in range(hi - lo):
                for at in wanted[lo + d]:
                    x, y = _around(w, d, at)
                    row.append(lo + d)
                    ats.append(at)
                    before.append(x.tobytes())
                    after.append(y.tobytes())
            where = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(where), batch.column(1).take(where), pa.array(ats, pa.int32()), pa.array(before, pa.binary()), pa.array(after, pa.binary())], names=["id", "h", "at", "before", "after"]
            )


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, h, from, to) of rows (id, h, at, before, after, and both of the match): a window with the words around it that are the same."""
    for batch in batches:
        at = batch.column(2).to_numpy()
        grown = []
        for k in (3, 4):
            pairs = zip(batch.column(k).to_pylist(), batch.column(k + 2).to_pylist(), strict=True)
            grown.append(np.array([_agree(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in pairs], np.int64))
        cols = [batch.column(0), batch.column(1), pa.array((at - grown[0]).astype(np.int32)), pa.array((at + WINDOW + grown[1]).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(cols, names=["id", "h", "from", "to"])


def _cut(place: int):
    """Rows (row, spans, firsts) without the words of the spans in field ``place`` of the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            fields = rows.flatten()
            raw, off = tokens.buffers(fields[place])
            wanted = batch.column(1).to_pylist()
            texts, spans = fields[place].to_pylist(), [[] for _ in wanted]
            for k in [k for k, x in enumerate(wanted) if x]:
                w = tokens.words(raw, off[k : k + 2])
                spans[k] = _merged([(s["from"], s["to"]) for s in wanted[k]])
                texts[k] = _without(raw[int(off[k]) : int(off[k + 1])].tobytes(), w.start, w.end, spans[k]).decode("utf-8", "replace")
            fields[place] = pa.array(texts, fields[place].type)
            yield pa.RecordBatch.from_arrays(
                [pa.StructArray.from_arrays(fields, fields=list(rows.type)), pa.array(spans, pa.list_(pa.list_(pa.int32()))), batch.column(2)], names=["row", "cut_spans", "kept_in"]
            )

    return run


def _nullable(kind: T.StructType) -> T.StructType:
    text = kind.json()
    for word in ("nullable", "containsNull", "valueContainsNull"):
        text = text.replace(f'"{word}":false', f'"{word}":true')
    return T.StructType.fromJson(json.loads(text))


def repeats(places: DataFrame, parts: DataFrame, met: DataFrame, store: Store) -> DataFrame:
    """(id, h, from, to, first_id) of all of ``places(id, h, from, to, rep)`` that repeat one of a document of a smaller id, by what ``_met`` found.

    Texts of paragraphs come from ``parts``, which are freed once those of paragraphs with a bucket in common are written.
    """
    named = met.where("kind = 1").select(F.col("key").alias("rep"), "bands")

    def texts(crowd: DataFrame) -> DataFrame:
        each = parts.select(F.explode(F.arrays_zip("names", "texts")).alias("p")).select(F.col("p.names").alias("rep"), F.col("p.texts").alias("text"))
        found = store.put(each.join(crowd, "rep", "left_semi").groupBy(F.col("rep").alias("id")).agg(F.any_value("text").alias("text")), "worded")
        store.drop("parts")
        return found

    linked = store.put(minhash.link(named.select(F.explode("bands").alias("bucket"), "rep"), texts, store), "linked")
    ids = places.groupBy("rep").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    of_rep = store.put(ids.join(linked, "rep", "left").select("rep", F.coalesce("component", "rep").alias("component"), "first_id", "last_id"), "of-rep")
    groups = of_rep.groupBy("component").agg(F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id")).where("first_id < last_id")
    gone = store.put(of_rep.select("rep", "component").join(groups, "component").select("rep", "first_id"), "gone")
    return places.join(gone, "rep").where("id > first_id").select("id", "h", "from", "to", "first_id")


def runs(source: DataFrame, met: DataFrame, store: Store) -> DataFrame:
    """(id, h, from, to, first_id) of verbatim runs of words that a document of a smaller id has too, of ``source(id, h, text)``, by ``_met``'s marks.

    Every run of at least 47 words is found whatever its lines, and of shorter
    ones of 32 or more those that hold a mark; ``first_id`` is null for the
    words by which a match has grown.
    """
    found = met.where("kind = 2").select("id", "h", "at", "first_id", "first_h", "first_at")
    grouped = found.groupBy("id", "h").agg(F.collect_list(F.struct("at", "first_id", "first_h", "first_at")).alias("matches"))
    edges = store.put(grouped.mapInArrow(_edges, "id long, h long, at int, first_id long, first_h long, first_at int"), "edges")
    asked = edges.select("id", "h", "at").union(edges.select("first_id", "first_h", "first_at")).groupBy("id", "h").agg(F.collect_set("at").alias("ats"))
    around = source.join(asked, ["id", "h"]).dropDuplicates(["id", "h"]).select("id", "h", "text", "ats")
    around = store.put(around.mapInArrow(_surroundings, "id long, h long, at int, before binary, after binary"), "around")
    theirs = around.select(F.col("id").alias("first_id"), F.col("h").alias("first_h"), F.col("at").alias("first_at"), F.col("before").alias("b"), F.col("after").alias("a"))
    both = edges.join(around, ["id", "h", "at"]).join(theirs, ["first_id", "first_h", "first_at"]).select("id", "h", "at", "before", "after", "b", "a")
    grown = both.mapInArrow(_grown, "id long, h long, from int, to int").select("*", F.lit(None).cast("long").alias("first_id"))
    return found.select("id", "h", F.col("at").alias("from"), (F.col("at") + WINDOW).alias("to"), "first_id").union(grown)


def cut(docs: DataFrame, store: Store | None = None, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs`` without the passages that stand in a document of a smaller id.

    Passages are paragraphs of at least ``least`` words, linked if the Jaccard
    similarity of their sets of 5-word shingles is at least 0.75, confirmed on
    the full sets: of each component the document of the smallest id keeps its
    paragraphs.  They are also all verbatim runs of 47 words or more, as far as
    the first document that holds their outer marks agrees (which leaves at most
    15 words at an end).  ``cut_spans`` are the ranges of words (from, past the last) that
    went from a text, ``kept_in`` the ids of the documents in which they stay;
    columns of these names are replaced.

    Rows of one id are one document: none is cut for another's sake, nor is
    what repeats only within a document.  Rows without an id or a text stay as
    they are.  Equal rows fare alike.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    store = store or Store(spark, "passages")
    key = [F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("h")]
    source = docs.select(*key, F.col(text_col).cast("string").alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    parts = store.put(source.mapInArrow(_sketch(least, part_bytes), _PART), "parts")
    sizes = parts.agg(F.sum(F.size("names") * BANDS), F.sum(F.size("m_at"))).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-max(sizes[0] or 0, sizes[1] or 0) // packed.BUCKET_KEYS))
    answers = store.put(packed.settle(parts.select("part", "ids", "hs", "bands", "m_row", "m_at", "marks").mapInArrow(_ask(buckets), packed.ASKED)), "answers")
    shown = parts.select("part", "ids", "hs", "names", "bands", "m_row", "m_at", "marks")
    fields = "kind int, key long, id long, h long, at int, first_id long, first_h long, first_at int, bands array<long>"
    met = store.put(shown.groupBy("part").cogroup(answers.where("part >= 0").groupBy("part")).applyInArrow(_met(buckets), fields), "met")
    each = F.explode(F.arrays_zip("p_row", "p_from", "p_to", "p_name")).alias("p")
    places = parts.select("ids", "hs", each).select(
        F.get("ids", F.col("p.p_row")).alias("id"), F.get("hs", F.col("p.p_row")).alias("h"), F.col("p.p_from").alias("from"), F.col("p.p_to").alias("to"), F.col("p.p_name").alias("rep")
    )
    places = store.put(places, "places")
    store.drop("answers")
    gone = store.put(repeats(places, parts, met, store), "paragraphs")
    store.drop("places", "worded", "linked", "of-rep", "gone", "crowd")
    gone = gone.union(runs(source, met, store))
    spans = gone.groupBy("id", "h").agg(F.collect_set(F.struct("from", "to")).alias("spans"), F.sort_array(F.collect_set("first_id")).alias("firsts"))
    spans = store.put(spans.select(F.col("id").alias("__id"), F.col("h").alias("__h"), "spans", "firsts"), "spans")
    store.drop("met", "paragraphs", "edges", "around")
    own = [c for c in docs.columns if c not in ("cut_spans", "kept_in")]
    kind = _nullable(docs.select(*own).schema)
    keyed = docs.select(F.struct(*own).cast(kind).alias("__row"), key[0].alias("__of"), key[1].alias("__as"))
    joined = keyed.join(spans, (F.col("__of") == F.col("__id")) & (F.col("__as") == F.col("__h")), "left").select("__row", "spans", F.coalesce("firsts", F.array().cast("array<long>")).alias("firsts"))
    out = T.StructType([T.StructField("row", kind), *T._parse_datatype_string("cut_spans array<array<int>>, kept_in array<long>").fields])
    store.free()
    return joined.mapInArrow(_cut(own.index(text_col)), out).select("row.*", "cut_spans", "kept_in")
