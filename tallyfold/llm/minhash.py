"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import tokens
from tallyfold.llm.graph import components
from tallyfold.llm.store import Store, whole_row

#: Words in a shingle, and the similarity in percent from which two sets are near duplicates.
SHINGLE, PERCENT = 5, 75
#: Bands of minima, and minima in a band: 0.99983 of pairs at a similarity of 0.75 meet in a band.
BANDS, ROWS = 32, 5
#: Rows of a bucket that one task compares with each other; a larger bucket goes as pairs of blocks.
BLOCK = 4096
#: Bytes of shingle sets that a block of a bucket is meant to hold at most.
BLOCK_BYTES = 64 << 20

_U32 = np.uint32


def _mix32(x: np.ndarray, spare: np.ndarray) -> None:
    """A bijection of 32-bit numbers, in place (murmur3's finaliser)."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 0)):
        np.right_shift(x, _U32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        if factor:
            np.multiply(x, _U32(factor), out=x)


def signatures(runs: np.ndarray, first: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """A row of ``size`` minima for each set ``runs[first[d]:first[d + 1]]``, from two permutations of the 32-bit circle.

    The first permutation scatters the sets; coordinate k is the minimum of the
    second one, shifted by k places around the circle.  An element that stands
    repeatedly counts once, and the minima of an empty set are the circle's end.
    """
    out = np.full((len(first) - 1, size), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(first))
    if not len(some):
        return out
    x = (runs >> np.uint64(32)).astype(np.uint32)
    x ^= _U32(0x5BD1E995)
    _mix32(x, np.empty_like(x))
    spare, shifted = np.empty_like(x), np.empty_like(x)
    for k in range(size):
        np.add(x, _U32(k), out=shifted)
        _mix32(shifted, spare)
        out[some, k] = np.minimum.reduceat(shifted, first[some])
    return out


def band_keys(sigs: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` minima, for each row of signatures."""
    grid = sigs.reshape(len(sigs), sigs.shape[1] // rows, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, grid.shape[1] + 1, dtype=np.uint64), grid.shape[:2])
    for k in range(rows):
        key = tokens.mix64(key * np.uint64(0x9E3779B97F4A7C15) + grid[:, :, k])
    return key


def _own(w: tokens.Words) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Each document's set, and all shingles with where each document's begin."""
    runs, first = tokens.shingles(w, SHINGLE)
    return [np.unique(runs[first[d] : first[d + 1]]) for d in range(len(first) - 1)], runs, first


def _digest(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, w in tokens.text_chunks(batch.column(1)):
            sets, runs, first = _own(w)
            n = np.array([len(x) for x in sets], np.int64)
            keys = band_keys(signatures(runs, first))
            off = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array(n),
                    pa.array([_digest(x) for x in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(off), pa.array(keys[n > 0].ravel().view(np.int64))),
                    batch.column(2).slice(lo, hi - lo),
                ],
                names=["id", "n", "digest", "bands", "text_hash"],
            )


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, n, sig): of texts, set sizes and the lowest bytes of the minima."""
    for batch in batches:
        for lo, hi, w in tokens.text_chunks(batch.column(1)):
            sets, runs, first = _own(w)
            sigs = signatures(runs, first).astype(np.uint8)
            columns = [batch.column(0).slice(lo, hi - lo), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sigs], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["rep", "n", "sig"])


#: Pairs for each row of a block that are checked by themselves; a block with more is checked within its task.
DIRECT = 4


def _least_agreeing(size: int) -> int:
    """Pairs that agree in fewer of ``size`` minima than four and a half deviations under the limit are not looked at again."""
    share = PERCENT / 100
    return int(size * (share - 4.5 * (share * (1 - share) / size) ** 0.5))


def _candidates(group: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Of a block's rows (see ``near_duplicates``): a row, and the rows that its minima don't rule out as partners."""
    comp = group.column("comp").to_numpy()
    size = group.column("n").to_numpy()
    mine = group.column("mine").to_numpy()
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint8).reshape(len(comp), -1)
    enough = _least_agreeing(sig.shape[1])
    left = np.arange(len(comp)) if i == j else np.flatnonzero(mine == i)
    right = left if i == j else np.flatnonzero(mine == j)
    for k in left:
        others = right[right > k] if i == j else right
        others = others[(comp[others] != comp[k]) & (100 * np.minimum(size[others], size[k]) >= PERCENT * np.maximum(size[others], size[k]))]
        others = others[(sig[others] == sig[k]).sum(axis=1) >= enough] if len(others) else others
        if len(others):
            yield int(k), others


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (a, b) of different components in a block; of a block with many, its key instead."""
    for group in whole_groups(batches, ["bucket", "i", "j"]):
        rep = group.column("rep").to_numpy()
        a, b = [], []
        for k, others in _candidates(group):
            a += [rep[k]] * len(others)
            b += rep[others].tolist()
            if len(a) > DIRECT * len(rep):
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64())] * 2 + [group.column(c).slice(0, 1).combine_chunks() for c in ("bucket", "i", "j")], names=["a", "b", "bucket", "i", "j"])
                break
        else:
            if a:
                none = [pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64()), *none], names=["a", "b", "bucket", "i", "j"])


def _linked_within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links of a block whose rows carry their shingle sets; one for two components that it joins."""
    for group in whole_groups(batches, ["bucket", "i", "j"]):
        rep, comp = group.column("rep").to_numpy(), group.column("comp").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group.column("own").to_pylist()]
        up: dict[int, int] = {}

        def root(c: int, up: dict[int, int] = up) -> int:
            while c in up:
                c = up[c]
            return c

        a, b = [], []
        for k, others in _candidates(group):
            for o in others:
                x, y = root(int(comp[k])), root(int(comp[o]))
                if x != y and similar(sets[k], sets[o]):
                    up[max(x, y)] = min(x, y)
                    a.append(min(rep[k], rep[o]))
                    b.append(max(rep[k], rep[o]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets have the least Jaccard similarity."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    shared = int((y[at] == x).sum()) if len(y) else 0
    return shared > 0 and 100 * shared >= PERCENT * (len(x) + len(y) - shared)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, w in tokens.text_chunks(batch.column(1)):
            own = pa.array([x.tobytes() for x in _own(w)[0]], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), own], names=["rep", "own"])


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of all rows of one key each, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        now = tuple(c[0] for c in cols)
        change[0] = last is not None and now != last
        cuts = np.flatnonzero(change)
        lo = 0
        for cut in cuts:
            part = batch.slice(lo, cut - lo)
            if part.num_rows or held:
                yield pa.Table.from_batches([*held, part] if part.num_rows else held)
            held, lo = [], int(cut)
        held.append(batch.slice(lo))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b, text of a, text of b) whose full shingle sets are similar enough."""
    for batch in batches:
        sets = []
        for col in (2, 3):
            own: list[np.ndarray] = []
            for _, _, w in tokens.text_chunks(batch.column(col)):
                own += _own(w)[0]
            sets.append(own)
        keep = [similar(x, y) for x, y in zip(*sets, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of ``pairs(a, b)``, those whose ``texts(id, text)`` have similar shingle sets."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb").mapInArrow(_verified, "a long, b long")


def link(shared: DataFrame, texts: Callable[[DataFrame], DataFrame], store: Store) -> DataFrame:
    """(rep, component) of ``shared(bucket, rep)``, by verified similarity of the texts of reps that share a bucket.

    Reps that share no bucket with another are left out.  ``texts`` gives
    (id, text) of the reps in a table (rep), once each.

    Within a band's bucket, all rows are first compared with the smallest rep
    alone, so that a group of near copies costs its size.  Only buckets that
    hold several components after that are compared row by row, in blocks, and
    only rows of different components.  A block with many candidate pairs is
    checked within its task, on the sets, and gives only links.  A bucket has as
    many blocks as its rows, and the bytes of their sets, ask for.
    """
    rows = store.put(shared, "banded")
    stars = rows.groupBy("bucket").agg(F.min("rep").alias("centre"), F.max("rep").alias("last")).where("centre < last")
    # from here on only buckets that hold different sets
    shared = store.put(rows.join(stars.select("bucket", "centre"), "bucket").distinct(), "shared")
    store.drop("banded")
    crowd = store.put(shared.select("rep").distinct(), "crowd")
    texts = store.put(texts(crowd), "texts")
    reps = store.put(texts.select("id", "text").mapInArrow(_signed, "rep long, n long, sig binary"), "involved")
    sizes = reps.select("rep", "n")
    first = store.put(
        shared.where("rep <> centre")
        .select("rep", "centre")
        .distinct()
        .join(sizes, "rep")
        .join(sizes.select(F.col("rep").alias("centre"), F.col("n").alias("cn")), "centre")
        .where(f"100 * least(n, cn) >= {PERCENT} * greatest(n, cn)")
        .select(F.col("centre").alias("a"), F.col("rep").alias("b")),
        "stars",
    )
    links = store.put(verify(first, texts), "links-1")
    found = components(links, store, "cc1")

    named = shared.join(found.select(F.col("v").alias("rep"), F.col("component")), "rep", "left").join(sizes, "rep").select("bucket", "rep", "n", F.coalesce("component", "rep").alias("comp"))
    named = store.put(named, "named")
    mixed = named.groupBy("bucket").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("members > 2 AND lo <> hi")
    mixed = mixed.select("bucket", F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(8 * F.col("shingles") / BLOCK_BYTES)).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks").cast("long")).cast("int")
    dealt = (
        named.join(mixed, "bucket")
        .select("bucket", "rep", "comp", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .join(reps, "rep")
        .select("bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "rep", "comp", "n", "sig")
    )
    looked = store.put(
        dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(_agreeing, "a long, b long, bucket long, i int, j int"),
        "leftovers",
    )
    second = looked.where("a IS NOT NULL").select("a", "b").distinct().join(first, ["a", "b"], "left_anti")
    crowded = dealt.join(looked.where("a IS NULL").select("bucket", "i", "j"), ["bucket", "i", "j"], "left_semi")
    inside = crowded.select("rep").distinct().join(texts.select(F.col("id").alias("rep"), "text"), "rep").select("rep", "text")
    own = store.put(inside.mapInArrow(_sets, "rep long, own binary"), "sets")
    within = crowded.join(own, "rep").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    more = verify(second, texts).union(within.mapInArrow(_linked_within, "a long, b long"))
    to_a = found.select(F.col("v").alias("a"), F.col("component").alias("ca"))
    to_b = found.select(F.col("v").alias("b"), F.col("component").alias("cb"))
    joined = more.join(to_a, "a", "left").join(to_b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    over = components(joined, store, "cc2").select(F.col("v").alias("comp"), F.col("component").alias("over"))
    store.drop("stars", "links-1", "shared", "named", "involved", "leftovers", "sets", "texts")
    return (
        crowd.join(found.select(F.col("v").alias("rep"), "component"), "rep", "left")
        .select("rep", F.coalesce("component", "rep").alias("comp"))
        .join(over, "comp", "left")
        .select("rep", F.coalesce("over", "comp").alias("component"))
    )


def _as_named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (rep, digest, text), those whose text has the set of that digest."""
    for batch in batches:
        keep = []
        for lo, _, w in tokens.text_chunks(batch.column(2)):
            keep += [_digest(x) == batch.column(1)[lo + d].as_py() for d, x in enumerate(_own(w)[0])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=["id", "text"]).filter(pa.array(keep, pa.bool_()))


def near_duplicates(docs: DataFrame, store: Store | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id, kept, text_hash, group.

    Documents are linked if the Jaccard similarity of their sets of 5-word
    shingles is at least 0.75, confirmed on the full sets; component_id is the
    smallest id that links lead to, the row's own included, and kept says that
    this is its own.  Texts that are null, empty or without words have an empty
    set and no links.  Rows of equal sets are one class, compared once, however
    many there are.  A row without an id has no component and is kept.  Rows of
    the same id stand for themselves: texts of theirs that differ are different
    classes, and links lead through a class, not through an id.  Other columns
    are not read.
    """
    store = store or Store(docs.sparkSession, "minhash")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    hashed = source.select("id", "text", F.xxhash64("text").alias("text_hash"))
    sketch = store.put(hashed.mapInArrow(_sketch, "id long, n long, digest binary, bands array<long>, text_hash long"), "sketch")
    full = sketch.where("n > 0 AND id IS NOT NULL")
    classes = full.groupBy("digest").agg(F.min("id").alias("least"), F.any_value("bands").alias("bands"))
    classes = store.put(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")

    def texts(crowd: DataFrame) -> DataFrame:
        asked = classes.join(crowd, "rep", "left_semi").select("rep", "digest", F.col("least").alias("id"))
        found = source.join(asked, "id").select("rep", "digest", "text").mapInArrow(_as_named, "id long, text string")
        return found.groupBy("id").agg(F.any_value("text").alias("text"))

    linked = store.put(link(classes.select(F.explode("bands").alias("bucket"), "rep"), texts, store), "linked")
    # a component goes by its smallest id
    least = classes.select("rep", "least").join(linked, "rep").groupBy("component").agg(F.min("least").alias("component_id"))
    moved = store.put(linked.join(least, "component").select("rep", "component", "component_id"), "moved")
    own = F.coalesce("component_id", "least").alias("component_id"), F.coalesce("component", "rep").alias("group")
    named = store.put(classes.select("digest", "rep", "least").join(moved, "rep", "left").select("digest", *own), "named")
    members = full.select("id", "n", "digest", "text_hash").join(named, "digest").select("id", "n", "component_id", "text_hash", "group")
    alone = sketch.where("NOT (n > 0 AND id IS NOT NULL)").select("id", "n", F.col("id").alias("component_id"), "text_hash", F.lit(None).cast("long").alias("group"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    return members.union(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", kept, "text_hash", "group")


def representatives(docs: DataFrame, store: Store | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay if one of each component does, whole and under their own names.

    That is the row of the smallest id; where several rows of a component have
    this id, the one whose text has the least hash; of rows that agree in id and
    text, any one.  Rows without words or without an id all stay.
    """
    store = store or Store(docs.sparkSession, "minhash")
    found = store.put(near_duplicates(docs, store, id_col, text_col).select(F.col(id_col).alias("__id"), "kept", "text_hash", "group"), "decided")
    first = found.where("kept AND group IS NOT NULL").groupBy("group").agg(F.min("__id").alias("__id"), F.min("text_hash").alias("least"), F.max("text_hash").alias("last"), F.count("*").alias("rows"))
    # seldom any: components with several rows of their smallest id
    several = store.put(first.where("rows > 1"), "several")
    later = found.where("kept").join(several.where("least < last").select("group", "least"), "group").where("text_hash > least")
    gone = found.where("NOT kept").select("__id", "text_hash").union(later.select("__id", "text_hash")).distinct().select("__id", F.col("text_hash").alias("__as"))
    # a row is carried as one column, so that no name of its own meets another
    rows = docs.select(whole_row(docs).alias("row"), F.col(id_col).cast("long").alias("__of"), F.xxhash64(F.col(text_col).cast("string")).alias("__hash"))
    left = rows.join(gone, (F.col("__of") == F.col("__id")) & (F.col("__hash") == F.col("__as")), "left_anti")
    again = several.select("__id", F.col("least").alias("__as"))
    if again.isEmpty():
        return left.select("row.*")
    same = (F.col("__of") == F.col("__id")) & (F.col("__hash") == F.col("__as"))
    once = left.join(again, same, "left_semi").groupBy("__of", "__hash").agg(F.first("row").alias("row"))
    return left.join(again, same, "left_anti").select("row.*").union(once.select("row.*"))
