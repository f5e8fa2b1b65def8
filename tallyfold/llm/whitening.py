"""Whitening of embeddings: covariance by one aggregation of centred products, components by LAPACK."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Each entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024.0, 100_000
#: A scaled entry beyond this counts as this, so that sums of longs hold.
LARGEST = float(1 << 40)
#: Components that are returned at most.
COMPONENTS = 8
#: Pairs of dimensions that one aggregation sums; more dimensions (over 127) take several.
PAIRS = 8_192


def usable(vector: Column) -> Column:
    """Whether a vector has entries, none of them null, NaN or infinite."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector.cast("array<double>"), finite), F.lit(False))


def whole(vector: Column) -> Column:
    """Entries as long integers."""
    scaled = lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))).cast("long") + SHIFT
    return F.transform(vector.cast("array<double>"), scaled)


def fit_list(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x) of the usable vectors, as integers."""
    return vectors.where(usable(F.col(vector_col))).select(F.col(id_col).cast("long").alias("id"), whole(F.col(vector_col)).alias("x"))


@dataclass(frozen=True)
class Whitening:
    """What all vectors together say: how many there are, sums, the components (columns, by falling variance), their variances and their sum."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return self.sums / self.n

    @property
    def matrix(self) -> np.ndarray:
        """Takes a centred vector to its whitened coordinates; NaN where a component has no variance."""
        least = len(self.sums) * np.finfo(float).eps * max(self.variances[0], 0.0)
        scale = np.array([e**-0.5 if e > least else np.nan for e in self.variances])
        return self.components * scale


def covariance(rows: DataFrame, n: int, mean: np.ndarray, at_once: int = PAIRS) -> np.ndarray:
    """The covariance of ``x``, divisor n: the upper triangle as sums of products of centred entries."""
    width = len(mean)
    centred = rows.selectExpr(*[f"x[{i}] - {m!r}D AS d{i}" for i, m in enumerate(mean.tolist())])
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    out = np.empty((width, width))
    for some in itertools.batched(pairs, at_once):
        sums = centred.selectExpr(*[f"sum(d{i} * d{j}) AS s{k}" for k, (i, j) in enumerate(some)]).first()
        for (i, j), s in zip(some, sums, strict=True):
            out[i, j] = out[j, i] = s / n
    return out


def fit(rows: DataFrame, components: int = COMPONENTS, at_once: int = PAIRS) -> Whitening | None:
    """Components of the rows' ``x``; None without rows.

    The width of the model is the one that most rows have, of equally frequent
    ones the largest; rows of other widths teach nothing.  Each component's sign
    is such that its largest entry is positive.
    """
    widths = rows.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("width"))
    most = widths.first()
    if most is None:
        return None
    width, n = most["width"], most["n"]
    own = rows.where(F.size("x") == width)
    sums = np.array(own.selectExpr(*[f"sum(x[{i}]) AS s{i}" for i in range(width)]).first(), np.int64)
    found = covariance(own, n, sums / n, at_once)
    values, vectors = np.linalg.eigh(found)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return Whitening(n, sums, vectors, values, float(np.trace(found)))


def _apply(model: Whitening):
    mean, matrix, width = model.mean, model.matrix, len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, width)
            # sums of squares modulo 2^64 are exact as long as they are below 2^63
            far = model.n * x - model.sums
            exact = (far * far).sum(1)
            about = (far.astype(float) ** 2).sum(1)
            w = (x - mean) @ matrix
            coordinates = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1], pa.array(w.ravel(), from_pandas=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(exact, mask=about >= 2.0**63), coordinates], names=["id", "deviation", "whitened"])

    return run


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation, whitened) of the rows of the model's width.

    deviation is the sum over dimensions of (n * x - sum)^2, null where it
    doesn't fit a long; whitened has an entry for each component, null for one
    without variance.
    """
    return rows.where(F.size("x") == len(model.sums)).select("id", "x").mapInArrow(_apply(model), "id long, deviation long, whitened array<double>")


def identity_error(applied: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened vectors' covariance minus the identity; None without variance."""
    live = np.flatnonzero(np.isfinite(model.matrix).all(0)).tolist()
    pairs = [(i, j) for i in live for j in live if i <= j]
    if not pairs:
        return None
    found = applied.select(*[F.covar_pop(F.get("whitened", i), F.get("whitened", j)) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, found, strict=True))


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each usable vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or empty, or hold null, NaN or infinite entries, are
    left out, as are those of another width than most have.  All others are the
    fit list, repeated rows as often as they stand there, a row without an id
    too.  ``explained`` is the component's share of the variance.  There are no
    more components than dimensions; one without variance has null coordinates.
    An empty table gives an empty result.  Other columns are not read.
    """
    rows = fit_list(vectors, id_col, vector_col)
    model = fit(rows, components)
    names = [F.col("id").alias(id_col), "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if model is None:
        empty = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], empty).select(*names)
    applied = apply(rows, model)
    error = identity_error(applied, model)
    shares = F.array(*[F.lit(float(e) / model.trace if model.trace > 0 else None).cast("double") for e in model.variances])
    long = applied.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long.select(
        "id", "deviation", "whitened", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), F.get(shares, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error")
    ).select(*names)
