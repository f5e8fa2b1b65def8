"""Sorted 64-bit keys in packed rows, and what all parts together hold of each part's keys.

A part is what one row of a table holds, some MB of text.  Each part sends its
distinct keys once to buckets that are ranges of the key, with how often it has
them; a bucket answers with the places of those that other parts hold too.  So
a key, however common, costs a bucket one entry for each part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Keys that a bucket is meant to get.
BUCKET_KEYS = 1_000_000

ASKED = "size int, bucket int, part long, m int, keys binary, n binary, places binary"
ANSWERED = "part long, size int, bucket int, m long, mask binary, n binary, places binary"

#: Where a key stands first: three columns by which places are in order.
PLACE = np.dtype([("id", "i8"), ("h", "i8"), ("at", "i4")])


def planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte: all lowest bytes, then all second ones, and so on; what is small compresses to little."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def zstd(data: bytes, size: int | None = None) -> bytes:
    """``data`` compressed, or with its full ``size``, what it was."""
    return pa.compress(data, codec="zstd", asbytes=True) if size is None else pa.decompress(data, size, codec="zstd", asbytes=True)


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as compressed gaps."""
    return zstd(planes(np.diff(keys, prepend=np.uint64(0))))


def unpack(data: bytes, m: int) -> np.ndarray:
    return np.cumsum(from_planes(zstd(data, 8 * m), "u8"), dtype=np.uint64)


def bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys begin among sorted ones."""
    return np.searchsorted((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))


def _pack_places(places: np.ndarray) -> bytes:
    return zstd(b"".join(planes(np.ascontiguousarray(places[c])) for c in PLACE.names))


def _places(data: bytes, m: int) -> np.ndarray:
    raw, out, at = zstd(data, m * PLACE.itemsize), np.empty(m, PLACE), 0
    for c in PLACE.names:
        to = at + m * PLACE[c].itemsize
        out[c] = from_planes(raw[at:to], PLACE[c].str)
        at = to
    return out


def question(part: int, size: int, keys: np.ndarray, n: np.ndarray, buckets: int, places: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of ``ASKED``: a part's sorted distinct keys and their counts, and where each stands first in it, one row for each bucket that gets any."""
    at = bounds(keys, buckets)
    some = np.flatnonzero(np.diff(at))
    n = n.astype(np.uint32)
    spans = [(int(at[b]), int(at[b + 1])) for b in some]
    columns = [
        pa.array(np.full(len(some), size, np.int32)),
        pa.array(some.astype(np.int32)),
        pa.array(np.full(len(some), part, np.int64)),
        pa.array(np.diff(at)[some].astype(np.int32)),
        pa.array([pack(keys[a:z]) for a, z in spans], pa.binary()),
        pa.array([zstd(planes(n[a:z])) for a, z in spans], pa.binary()),
        pa.array([None if places is None else _pack_places(places[a:z]) for a, z in spans], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["size", "bucket", "part", "m", "keys", "n", "places"])


def _settle(group: pa.Table) -> pa.Table:
    m = group.column("m").to_numpy()
    keys = np.concatenate([unpack(x.as_py(), k) for x, k in zip(group.column("keys"), m.tolist(), strict=True)])
    n = np.concatenate([from_planes(zstd(x.as_py(), 4 * k), "u4") for x, k in zip(group.column("n"), m.tolist(), strict=True)]).astype(np.int64)
    first = None
    if group.column("places").null_count == 0:
        first = np.concatenate([_places(x.as_py(), k) for x, k in zip(group.column("places"), m.tolist(), strict=True)])
        order = np.lexsort((first["at"], first["h"], first["id"], keys))
    else:
        order = np.argsort(keys)
    own = keys[order]
    lead = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    total = np.add.reduceat(n[order], lead)
    everywhere = np.empty(len(keys), np.int64)
    everywhere[order] = np.repeat(total, np.diff(np.append(lead, len(own))))
    if first is not None:  # the first place of all parts'
        first[order] = np.repeat(first[order][lead], np.diff(np.append(lead, len(own))))
    more = everywhere != n
    ends = np.cumsum(m)
    rows = [(k, more[z - w : z], slice(z - w, z)) for k, (w, z) in enumerate(zip(m.tolist(), ends.tolist(), strict=True))]
    rows = [(k, hit, everywhere[at][hit], None if first is None else _pack_places(first[at][hit])) for k, hit, at in rows if hit.any()]
    size, bucket = group.column("size")[0].as_py(), group.column("bucket")[0].as_py()
    parts = group.column("part").to_numpy()
    return pa.table(
        {
            # the last row tells how many different keys have been counted
            "part": pa.array([*(int(parts[k]) for k, _, _, _ in rows), -1], pa.int64()),
            "size": pa.array([size] * (len(rows) + 1), pa.int32()),
            "bucket": pa.array([bucket] * (len(rows) + 1), pa.int32()),
            "m": pa.array([*(len(hit) for _, hit, _, _ in rows), int((total > 0).sum())], pa.int64()),
            "mask": pa.array([*(np.packbits(hit).tobytes() for _, hit, _, _ in rows), None], pa.binary()),
            "n": pa.array([*(planes(found) for _, _, found, _ in rows), None], pa.binary()),
            "places": pa.array([*(place for _, _, _, place in rows), None], pa.binary()),
        }
    )


def settle(asked: DataFrame) -> DataFrame:
    """``ANSWERED``: for each question, which keys have another count over all parts, and that count.

    A row of part -1 gives the number of different keys of its bucket that have a count at all.
    """
    return asked.groupBy("size", "bucket").applyInArrow(_settle, ANSWERED)


def placed(keys: np.ndarray, first: np.ndarray, answers: pa.Table, size: int, buckets: int) -> np.ndarray:
    """Where each of a part's keys stands first over all parts, from where it does in the part."""
    first = first.copy()
    at = bounds(keys, buckets)
    for row in _rows(answers, size):
        hit = int(at[row["bucket"]]) + np.flatnonzero(np.unpackbits(np.frombuffer(row["mask"], np.uint8), count=row["m"]))
        first[hit] = _places(row["places"], len(hit))
    return first


def counted(keys: np.ndarray, n: np.ndarray, answers: pa.Table, size: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts over all parts of a part's keys of one size, and which of them other parts have to do with."""
    n = n.astype(np.int64)
    more = np.zeros(len(keys), bool)
    at = bounds(keys, buckets)
    for row in _rows(answers, size):
        a, m = int(at[row["bucket"]]), row["m"]
        hit = a + np.flatnonzero(np.unpackbits(np.frombuffer(row["mask"], np.uint8), count=m))
        n[hit] = from_planes(row["n"], "i8")
        more[hit] = True
    return n, more


def _rows(answers: pa.Table, size: int) -> Iterator[dict]:
    for k in np.flatnonzero(answers.column("size").to_numpy() == size).tolist():
        yield {c: answers.column(c)[k].as_py() for c in ("bucket", "m", "mask", "n", "places")}
