"""Whitening of embeddings by shifted CholeskyQR.

Vectors become whole numbers first, so their sums are exact. Each Gram pass is one Spark job: tasks centre
their rows, bring them through the triangular solves of the factors found so far, and hand on the upper
triangle of their Gram matrix, which Spark sums by place. The driver holds only matrices of the vectors'
dimension. The composed factor R has the singular values and right singular vectors of the centred rows, so
its decomposition gives the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerscore.llm.common import fresh_names

#: A component of a vector, c, is taken as floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: From this size on, a component has no whole number of 64 bits.
TOO_LARGE = float(2**52)
#: Singular values below this part of the largest belong to directions without variance.
NO_VARIANCE = 1e-11
#: Gram passes: at least three, and more while columns are not orthonormal.
PASSES, MOST_PASSES, ORTHONORMAL = 3, 6, 1e-9
#: Numbers of a batch that are worked on at a time.
WORKED = 1 << 21
_OUT = ["deviation", "whitened"]


@dataclass(frozen=True)
class Centre:
    """Column means as whole numbers and remainders: the mean of column i is ``whole[i] + rest[i] / n``."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, sums: list[int], n: int) -> Centre:
        parts = [divmod(s, max(n, 1)) for s in sums]
        return cls(n, np.array([p[0] for p in parts], dtype=np.int64), np.array([p[1] for p in parts], dtype=np.int64))

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / max(self.n, 1)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of squares of ``n * x - sum``, exact; None where they exceed 64 bits."""
        away = x - self.whole
        reach = float(np.abs(away).max(initial=0)) * self.n + self.n
        if reach * reach * x.shape[1] < 2.0**62:
            return ((away * self.n - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((away.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in exact]


@dataclass(frozen=True)
class Whitening:
    """``components`` has a column per component; ``eigenvalues`` and ``explained`` go with them."""

    centre: Centre
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def dimension(self) -> int:
        return len(self.components)

    @property
    def projection(self) -> np.ndarray:
        return self.components / np.sqrt(self.eigenvalues)


def usable(vector: Column, dimension: int | None = None) -> Column:
    """Whether a vector takes part: not null or empty, of the dimension, all entries finite and of 64 bits."""
    entries = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < TOO_LARGE))
    size = F.size(vector) > 0 if dimension is None else F.size(vector) == dimension
    return F.coalesce(vector.isNotNull() & size & entries, F.lit(False))


def dimension_of(df: DataFrame, vector_col: str) -> int:
    """The commonest length of usable vectors, the larger of equally common ones; 0 without any."""
    sizes = df.where(usable(F.col(vector_col))).groupBy(F.size(vector_col).alias("size")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def _whole(values: np.ndarray, dimension: int) -> np.ndarray:
    scaled = np.floor(values.astype(np.float64) * SCALE).astype(np.int64)
    return (scaled + OFFSET).reshape(-1, dimension)


def _matrices(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[np.ndarray]:
    rows = max(1, WORKED // dimension)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.column(0).slice(start, rows)
            yield _whole(part.flatten().to_numpy(zero_copy_only=False), dimension)


def _sums(vectors: DataFrame, dimension: int) -> tuple[list[int], int]:
    """Exact column sums and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(dimension, dtype=object), 0
        for x in _matrices(batches, dimension):
            small = float(np.abs(x).max(initial=0)) * len(x) < 2.0**62
            sums += (x if small else x.astype(object)).sum(axis=0).astype(object)
            n += len(x)
        if n:
            digits = pa.array([str(int(s)) for s in sums])
            yield pa.RecordBatch.from_arrays([pa.array(range(dimension), pa.int32()), digits, pa.array([n] * dimension)], ["i", "s", "n"])

    parts = vectors.mapInArrow(run, "i int, s string, n long")
    total = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    found = total.orderBy("i").collect()
    return [int(r["s"]) for r in found], found[0]["n"] if found else 0


def _solve(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangular factor, column by column."""
    out = np.empty_like(rows, order="F")
    for j in range(len(factor)):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _gram(vectors: DataFrame, dimension: int, centre: Centre, width: int, derive: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of the outer products of what ``derive`` makes of each centred row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _matrices(batches, dimension):
            a = derive(centre.rows(x))
            total = a.T @ a if total is None else total + a.T @ a
        if total is not None:
            upper = pa.array([total[i, i:].tolist() for i in range(width)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), upper], ["i", "upper"])

    entries = vectors.mapInArrow(run, "i int, upper array<double>").select("i", F.posexplode("upper").alias("k", "v"))
    found = entries.groupBy("i", "k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((width, width))
    for i, k, v in found:
        out[i, i + k] = out[i + k, i] = v
    return out


def _shifted_cholesky(gram: np.ndarray, always: bool) -> np.ndarray:
    """Upper factor of the Gram matrix plus the smallest shift, by powers of ten, that lets it exist.

    The first pass always shifts, since its matrix may be singular but for rounding.
    """
    least = len(gram) * np.finfo(float).eps * max(np.trace(gram), np.finfo(float).tiny)
    shift = least if always else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, least)


def fit(df: DataFrame, vector_col: str = "embedding", components: int = 8) -> Whitening:
    """The leading components of all usable rows of ``df``, at most ``components`` of those with variance.

    Vectors take part that are not null or empty, have the commonest length (the larger of equally common
    ones) and hold neither nulls nor entries that are not finite or reach 2**52. Repeated rows count each.
    Without such rows, or where all are alike, there are no components. Equal eigenvalues come in any order.
    A component's sign makes its largest entry positive.
    """
    dimension = dimension_of(df, vector_col)
    vectors = df.where(usable(F.col(vector_col), dimension)).select(vector_col)
    sums, n = _sums(vectors, dimension) if dimension else ([], 0)
    centre = Centre.of(sums, n)
    none = Whitening(centre, np.zeros((dimension, 0)), np.zeros(0), np.zeros(0))
    if not n:
        return none

    factors: list[np.ndarray] = []

    def orthogonalised(a: np.ndarray) -> np.ndarray:
        for factor in factors:
            a = _solve(a, factor)
        return a

    for done in range(MOST_PASSES):
        gram = _gram(vectors, dimension, centre, dimension, orthogonalised)
        if not done and not np.trace(gram):
            return none
        if done >= PASSES and np.abs(gram - np.eye(dimension)).max() < ORTHONORMAL:
            break
        factors.append(_shifted_cholesky(gram, always=not factors))
    composed = np.eye(dimension)
    for factor in factors:
        composed = factor @ composed
    _, sigma, vt = np.linalg.svd(composed)
    kept = min(components, int((sigma > NO_VARIANCE * sigma[0]).sum()))
    chosen = vt[:kept].T * np.sign(vt[:kept].T[np.abs(vt[:kept]).argmax(axis=1), np.arange(kept)])
    eigenvalues = sigma[:kept] ** 2 / n
    model = Whitening(centre, chosen, eigenvalues, eigenvalues / (sigma**2).sum() * n)
    return Whitening(centre, chosen, eigenvalues, model.explained, _identity_error(vectors, model))


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, from one more Gram pass."""
    projection, k = model.projection, len(model.eigenvalues)
    moments = _gram(vectors, model.dimension, model.centre, k + 1, lambda a: np.column_stack([a @ projection, np.ones(len(a))]))
    n = model.centre.n
    mean = moments[:k, k] / n
    return float(np.abs(moments[:k, :k] / n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whiten(df: DataFrame, model: Whitening, vector_col: str = "embedding") -> DataFrame:
    """The usable rows of ``df`` with ``deviation`` and ``whitened``, one number per component.

    Rows that :func:`fit` would not use are dropped; those of other columns may be null. ``deviation`` is the
    sum over dimensions of (n * x - sum) ** 2, exact, or null beyond 64 bits. Input columns of these names
    are replaced, all others stay.
    """
    shared = df.sparkSession.sparkContext.broadcast((model.centre, model.projection, model.dimension))

    @F.pandas_udf("deviation long, whitened array<double>")
    def project(vectors: pd.Series) -> pd.DataFrame:
        centre, projection, dimension = shared.value
        deviations, whitened = [], []
        rows = max(1, WORKED // max(dimension, 1))
        for start in range(0, len(vectors), rows):
            x = _whole(np.concatenate(vectors.iloc[start : start + rows].to_list()), dimension)
            deviations += centre.deviations(x)
            whitened += (centre.rows(x) @ projection).tolist()
        return pd.DataFrame({"deviation": pd.array(deviations, dtype="Int64"), "whitened": whitened})

    kept = df.where(usable(F.col(vector_col), model.dimension or -1))
    own = fresh_names(kept, _OUT)
    made = own.select(F.struct(*[own[c] for c in own.columns]).alias("_in"), project(kept[vector_col]).alias("_w"))
    return made.select("_in.*", "_w.deviation", "_w.whitened")
