"""Byte-level BPE over whole texts, with a hierarchical-bitmap queue of merge ranks."""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A vocabulary file may be broadcast up to this size.
MAX_VOCABULARY_BYTES = 64 << 20
#: Bytes of distinct pre-tokens that are merged at once.
MERGE_BYTES = 16 << 20
#: Bytes from which a pre-token goes alone.
LONG_BYTES = 4096
_NONE = np.int32(2**31 - 1)


#: A space that a non-space follows, and texts that hold other spaces.
_ODD_SPACE, _ODD_SPACE_SEEN = re.compile(r" (?=\S)"), re.compile(r" (?:\s|\Z)")


def _gather(flat: np.ndarray, first: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices ``row`` of ``flat`` (slice k begins at ``first[k]``) in a row, and where each begins."""
    n = first[row + 1] - first[row]
    ends = np.cumsum(n)
    at = np.repeat(first[row] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)
    return flat[at], np.concatenate([[0], ends])


class RankQueue:
    """A set of ranks with find-first-set, as three levels of 64-way bitmaps; a bucket of positions for each."""

    def __init__(self, size: int):
        self.leaf = [0] * (size // 64 + 1)
        self.mid = [0] * (size // 4096 + 1)
        self.top = 0
        self.bucket: dict[int, list[np.ndarray]] = {}

    def push(self, rank: int, positions: np.ndarray) -> None:
        held = self.bucket.get(rank)
        if held is not None:
            held.append(positions)
            return
        self.bucket[rank] = [positions]
        self.leaf[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << ((rank >> 6) & 63)
        self.top |= 1 << (rank >> 12)

    def pop(self) -> tuple[int, list[np.ndarray]] | None:
        """The lowest rank and its bucket, taken out."""
        if not self.top:
            return None
        a = (self.top & -self.top).bit_length() - 1
        word = self.mid[a]
        b = a << 6 | (word & -word).bit_length() - 1
        word = self.leaf[b]
        rank = b << 6 | (word & -word).bit_length() - 1
        self.leaf[b] ^= 1 << (rank & 63)
        if not self.leaf[b]:
            self.mid[a] ^= 1 << (b & 63)
            if not self.mid[a]:
                self.top ^= 1 << a
        return rank, self.bucket.pop(rank)


class Codec:
    """Ranks of byte strings, and what encoding and decoding look up."""

    def __init__(self, vocabulary: bytes, pattern: str):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
        self.pattern = regex.compile(pattern)
        self.size = max(ranks.values()) + 1
        self.piece = [b""] * self.size
        for piece, rank in ranks.items():
            self.piece[rank] = piece
        self.decimal = [str(i).encode() for i in range(self.size)]
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        keys, values = [], []
        #: Ranks after whose merge a lower rank may come up beside it: those go one at a time.
        self.unsafe = np.zeros(self.size, bool)
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    values.append(rank)
                    for part in (left, right):
                        if rank < part:
                            self.unsafe[part] = True
        order = np.argsort(keys)
        self.keys, self.values = np.array(keys, np.int64)[order], np.array(values, np.int32)[order]
        self.pairs = dict(zip(keys, values, strict=True))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.values[at], _NONE)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and where each piece's begin.

        The pieces lie in one linked list that no pair crosses.  A bucket holds
        the positions of one rank's pairs; the lowest rank that has a bucket is
        taken next, and entries whose pair has changed since are skipped.  Of a
        rank after which a lower one may come up, each piece has its first pair
        merged; in a piece by itself, pairs are taken from a heap, one by one,
        until a lower rank has come up.
        """
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        first = np.concatenate([[0], np.cumsum(lengths)])
        n = int(first[-1])
        if not n:
            return np.zeros(0, np.int32), first
        ids = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        bounds = first[:-1][lengths > 0]
        before[bounds] = -1
        after[first[1:][lengths > 0] - 1] = -1
        alive = np.ones(n, bool)
        seen = np.zeros(n, bool)
        rank = np.full(n, _NONE, np.int32)
        inner = np.flatnonzero(after >= 0)
        rank[inner] = self.rank(ids[inner], ids[inner + 1])
        queue = RankQueue(self.size)

        def push(positions: np.ndarray) -> None:
            ranks = rank[positions]
            some = ranks != _NONE
            positions, ranks = positions[some], ranks[some]
            if len(positions) > 1:
                order = np.argsort(ranks, kind="stable")
                positions, ranks = positions[order], ranks[order]
                cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
                lo = 0
                for hi in [*cuts.tolist(), len(ranks)]:
                    queue.push(int(ranks[lo]), positions[lo:hi])
                    lo = hi
            elif len(positions):
                queue.push(int(ranks[0]), positions)

        heaps: dict[int, list[int]] = {}

        def one_by_one(r: int, held: list[np.ndarray]) -> None:
            heap = heaps.pop(r, [])
            for fresh in held:
                if heap:
                    for x in fresh.tolist():
                        heapq.heappush(heap, x)
                else:
                    heap = np.unique(fresh).tolist()
            lower = False
            while heap and not lower:
                at = heapq.heappop(heap)
                if not alive[at] or rank[at] != r:
                    continue
                gone = int(after[at])
                beyond, prior = int(after[gone]), int(before[at])
                ids[at] = r
                alive[gone] = False
                after[at] = beyond
                if beyond >= 0:
                    before[beyond] = at
                for left, right in ((prior, at), (at, beyond)):
                    if left >= 0:
                        found = self.pairs.get(int(ids[left]) * self.size + int(ids[right]), _NONE) if right >= 0 else _NONE
                        rank[left] = found
                        if found == r:
                            heapq.heappush(heap, left)
                        elif found != _NONE:
                            queue.push(found, np.array([left]))
                            lower |= found < r
            if heap:
                heaps[r] = heap
                queue.push(r, np.zeros(0, np.int64))

        push(inner)
        while (head := queue.pop()) is not None:
            r, held = head
            if self.unsafe[r] and len(pieces) == 1:
                one_by_one(r, held)
                continue
            at = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
            at = at[alive[at] & (rank[at] == r)]
            if not len(at):
                continue
            if self.unsafe[r]:
                piece = np.searchsorted(first, at, side="right")
                lead = np.concatenate([[True], piece[1:] != piece[:-1]])
                if not lead.all():
                    queue.push(r, at[~lead])
                at = at[lead]
            elif len(at) > 1:
                chained = after[at[:-1]] == at[1:]
                if chained.any():  # of overlapping pairs, every second one from the left
                    k = np.arange(len(at))
                    starts = np.maximum.accumulate(np.where(np.concatenate([[True], ~chained]), k, 0))
                    at = at[(k - starts) % 2 == 0]
            gone = after[at]
            beyond = after[gone]
            ids[at] = r
            alive[gone] = False
            after[at] = beyond
            linked = beyond >= 0
            before[beyond[linked]] = at[linked]
            prior = before[at]
            prior = prior[prior >= 0]
            seen[at] = True
            touched = np.sort(np.concatenate([at, prior[~seen[prior]]]))
            seen[at] = False
            rank[touched] = _NONE
            open_ = touched[after[touched] >= 0]
            rank[open_] = self.rank(ids[open_], ids[after[open_]])
            push(open_)
        counts = np.concatenate([[0], np.cumsum(alive)])
        return ids[alive], counts[first]

    def encode_texts(self, texts: list[str], break_at_space: bool = False) -> Iterator[np.ndarray]:
        """Ids of each text; what comes up again is split into pre-tokens and merged once.

        With ``break_at_space`` the pattern is known to break before any space
        that a non-space follows, and to match what lies between two such breaks
        as it would within the text.
        """
        number = itertools.count()
        lead: dict[str, int] = defaultdict(number.__next__)
        known: dict[str, int] = defaultdict(number.__next__)
        rows = []
        for text in texts:
            if not break_at_space:
                row = [lead[text]] if text else []
            else:
                parts = _ODD_SPACE.split(text) if _ODD_SPACE_SEEN.search(text) else text.split(" ")
                row = [lead[parts[0]]]
                row += map(known.__getitem__, parts[1:])
            rows.append(np.array(row, np.int32))
        order = np.argsort(np.fromiter(itertools.chain(lead.values(), known.values()), np.int64, len(lead) + len(known)))
        spans = [*lead, *(" " + x for x in known)]
        lead.clear()
        known.clear()
        token: dict[str, int] = defaultdict(itertools.count().__next__)
        inner, held = [], np.zeros(len(spans) + 1, np.int64)
        for k, at in enumerate(order.tolist()):
            found = self.pattern.findall(spans[at])
            inner += map(token.__getitem__, found)
            held[k + 1] = len(inner)
        del spans
        pieces = [x.encode() for x in token]
        token.clear()
        flat, first = self._merge_all(pieces)
        flat, first = _gather(flat, first, np.array(inner, np.int64))
        first = first[held]
        for row in rows:
            yield _gather(flat, first, row)[0]

    def _merge_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        parts, starts, lo, base = [], [np.zeros(1, np.int64)], 0, 0
        while lo < len(pieces):
            hi, room = lo + 1, MERGE_BYTES - len(pieces[lo])
            while len(pieces[lo]) < LONG_BYTES and hi < len(pieces) and len(pieces[hi]) < min(LONG_BYTES, room + 1):
                room -= len(pieces[hi])
                hi += 1
            ids, first = self.merge(pieces[lo:hi])
            parts.append(ids)
            starts.append(first[1:] + base)
            base += len(ids)
            lo = hi
        return np.concatenate([np.zeros(0, np.int32), *parts]), np.concatenate(starts)

    def decode(self, ids: list[int]) -> bytes:
        piece = self.piece
        return b"".join([piece[i] for i in ids])


@lru_cache(maxsize=4)
def codec(vocabulary: bytes, pattern: str) -> Codec:
    return Codec(vocabulary, pattern)


def _read(spark, path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return data


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", break_at_space: bool = False, ids: bool = True, digests: bool = False) -> DataFrame:
    """Each row's id and n_tokens; with ``ids`` the array ``ids``, with ``digests`` the hashes.

    ``vocabulary`` is a file of base64 pieces and ranks on the driver, sent to
    the executors up to ``MAX_VOCABULARY_BYTES``.  Every match of ``pattern`` is
    merged for itself; there are no special tokens.  ``break_at_space`` says that
    the pattern breaks before every space that a non-space follows.  A null or empty text has
    no ids.  ``digests`` adds ids_sha256 (of the decimal ids joined by one space)
    and decoded_sha256 (of the bytes the ids decode to).  Rows stay as they
    are, repeated or without an id; no row meets another.
    """
    data = docs.sparkSession.sparkContext.broadcast(_read(docs.sparkSession, vocabulary))
    fields = f"{id_col} long, n_tokens long" + ", ids array<int>" * ids + ", ids_sha256 string, decoded_sha256 string" * digests

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(data.value, pattern)
        for batch in batches:
            n, all_ids, coded, decoded = [], [], [], []
            for row in own.encode_texts([x or "" for x in batch.column(1).to_pylist()], break_at_space):
                n.append(len(row))
                if ids:
                    all_ids.append(row)
                if digests:
                    as_list = row.tolist()
                    coded.append(hashlib.sha256(b" ".join([own.decimal[i] for i in as_list])).hexdigest())
                    decoded.append(hashlib.sha256(own.decode(as_list)).hexdigest())
            columns = [batch.column(0), pa.array(n, pa.int64())]
            if ids:
                off = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate([np.zeros(0, np.int32), *all_ids]))))
            if digests:
                columns += [pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in fields.split(", ")])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, fields)


def decode(rows: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """The rows with the bytes that ``ids_col`` decodes to in ``decoded`` (null ids: null)."""
    data = rows.sparkSession.sparkContext.broadcast(_read(rows.sparkSession, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(data.value, r"\X")
        for batch in batches:
            at = batch.schema.get_field_index(ids_col)
            out = [None if x is None else own.decode(x) for x in batch.column(at).to_pylist()]
            yield batch.append_column("decoded", pa.array(out, pa.binary()))

    kept = rows.drop("decoded")
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("decoded", T.BinaryType())]))
