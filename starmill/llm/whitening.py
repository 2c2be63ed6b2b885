"""Whitening of embeddings: a pivoted Cholesky factor of the scatter, turned by one-sided Jacobi rotations.

The scatter is added up in whole numbers, so that it is exact and the same for
every division into tasks. Its triangular factor L (scatter = L L^T) is rotated
from the right until its columns are orthogonal; then their squared norms are
the eigenvalues and the columns, normalised, the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import map_arrow, written

_LONG = 1 << 63
#: Whole entries are held within these bounds, so that their differences are longs.
_LARGEST = 1 << 61


@dataclass(frozen=True)
class Whitening:
    """Entries c become the whole number floor(scale * c) + shift; at most ``components`` are returned."""

    scale: float = 1024.0
    shift: int = 100_000
    components: int = 8
    sweeps: int = 60


@dataclass
class Basis:
    """``n`` vectors with sums ``sums``, eigenvalues falling, components in columns, and the exact trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


# -- linear algebra of one small matrix ------------------------------------------


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with a = L L^T, columns by falling pivot; as many columns as the matrix has rank in double precision."""
    a = a.astype(float).copy()
    d = len(a)
    factor, order = np.zeros((d, d)), np.arange(d)
    least = d * np.finfo(float).eps * max(float(a.diagonal().max(initial=0)), 0.0)
    for k in range(d):
        rest = a[order[k:], order[k:]]
        best = int(rest.argmax())
        if rest[best] <= least:
            return factor[:, :k]
        order[[k, k + best]] = order[[k + best, k]]
        p, below = order[k], order[k + 1 :]
        factor[p, k] = np.sqrt(a[p, p])
        factor[below, k] = a[below, p] / factor[p, k]
        a[np.ix_(below, below)] -= np.outer(factor[below, k], factor[below, k])
    return factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared norms (falling) and directions of the columns after rotations that make them orthogonal."""
    u = factor.copy()
    r, tight = u.shape[1], np.finfo(float).eps * np.sqrt(len(u))
    for _ in range(sweeps):
        turned = False
        for i in range(r - 1):
            for j in range(i + 1, r):
                x, y = u[:, i], u[:, j]
                a, b, c = x @ x, y @ y, x @ y
                if abs(c) <= tight * np.sqrt(a) * np.sqrt(b):
                    continue
                turned = True
                zeta = (b - a) / (2 * c)
                t = (1.0 if zeta >= 0 else -1.0) / (abs(zeta) + np.hypot(1.0, zeta))
                cos = 1 / np.hypot(1.0, t)
                u[:, i], u[:, j] = cos * (x - t * y), cos * (y + t * x)
        if not turned:
            break
    norms = (u * u).sum(axis=0)
    order = np.argsort(-norms, kind="stable")
    u, norms = u[:, order], norms[order]
    vectors = u / np.sqrt(norms)
    # either sign would do; the largest entry is made positive
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(r)]) if r else np.ones(0)
    return norms, vectors * signs


# -- rows ----------------------------------------------------------------------


def whole_entries(how: Whitening, column: str = "embedding") -> Column:
    held = lambda v: F.least(F.greatest(v, F.lit(-_LARGEST)), F.lit(_LARGEST))
    return F.transform(column, lambda c: held(F.floor(F.lit(how.scale) * c.cast("double")).cast("long")) + F.lit(how.shift).cast("long"))


def usable(rows: DataFrame, how: Whitening, column: str = "embedding") -> DataFrame:
    """vec_id, x: the vectors without null or non-finite entries, in whole numbers.

    Vectors that are empty, or of another length than most (of equally many, the
    longer ones count), are dropped as well. Whole numbers beyond 2^61 in size
    are taken as that.
    """
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    good = F.col(column).isNotNull() & (F.size(column) > 0) & ~F.exists(column, bad)
    kept = rows.where(F.coalesce(good, F.lit(False)))
    lengths = kept.groupBy(F.size(column).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = lengths[0]["size"] if lengths else 0
    return kept.where(F.size(column) == size).select(F.col("vec_id").cast("long").alias("vec_id"), whole_entries(how, column).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(len(column), -1)


def _exact_products(d: np.ndarray) -> list[int]:
    """Sums of products of all pairs of columns i <= j, without rounding."""
    upper = np.triu_indices(d.shape[1])
    most = int(np.abs(d).max(initial=0))
    rows = (1 << 53) // max(1, most * most)
    if rows == 0:
        whole = d.astype(object)
        return [int(v) for v in (whole.T @ whole)[upper]]
    total = np.zeros((d.shape[1], d.shape[1]), object)
    for at in range(0, len(d), min(rows, 1 << 16)):
        part = d[at : at + min(rows, 1 << 16)].astype(float)
        total += (part.T @ part).astype(np.int64)  # below 2^53, so every sum in between is exact
    return [int(v) for v in total[upper]]


def _added(df: DataFrame, partial) -> dict[int, int]:  # type: ignore[no-untyped-def]
    """Whole numbers by place, added over all tasks: ``partial`` gives those of one batch as a list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for batch in batches:
            if batch.num_rows:
                values = partial(batch)
                total = [a + b for a, b in zip(total, values, strict=True)] if total else values
        halves = [[str(v >> 60) for v in total], [str(v & (1 << 60) - 1) for v in total]]
        yield pa.record_batch([pa.array(range(len(total)), pa.int64()), *[pa.array(h, pa.string()) for h in halves]], names=["place", "high", "low"])

    # in two halves, since a decimal has 38 digits only
    sums = [F.sum(F.col(half).cast("decimal(38,0)")).alias(half) for half in ("high", "low")]
    added = map_arrow(df, run, "place long, high string, low string").groupBy("place").agg(*sums)
    return {r["place"]: (int(r["high"]) << 60) + int(r["low"]) for r in added.collect()}


def fit(vectors: DataFrame, how: Whitening | None = None) -> Basis:
    """Eigenvalues and components of the covariance (divisor n) of the rows of ``vectors`` (x: array of longs of one length).

    Entries are centred on the whole numbers next to their means before they
    are multiplied; what that leaves of the means is taken off exactly.
    """
    how = how or Whitening()
    first = _added(vectors.select("x"), lambda batch: [batch.num_rows, *[int(v) for v in _matrix(batch.column("x")).astype(object).sum(axis=0)]])
    if not first.get(0):
        return Basis(0, [], np.empty(0), np.empty((0, 0)), 0.0)
    n, d = first[0], len(first) - 1
    sums = [first[i + 1] for i in range(d)]
    centre = [s // n for s in sums]

    def products(batch: pa.RecordBatch) -> list[int]:
        return _exact_products(_matrix(batch.column("x")) - np.array(centre, np.int64))

    second = _added(vectors.select("x"), products)
    left = [s - n * c for s, c in zip(sums, centre, strict=True)]
    exact = np.zeros((d, d), object)
    for k, (i, j) in enumerate(zip(*np.triu_indices(d), strict=True)):
        exact[i, j] = exact[j, i] = n * second[k] - left[i] * left[j]  # n^2 times the covariance
    covariance = np.array([[float(Fraction(v, n * n)) for v in row] for row in exact]).reshape(d, d)
    trace = float(Fraction(int(sum(exact.diagonal())), n * n))
    values, components = one_sided_jacobi(pivoted_cholesky(covariance), how.sweeps)
    return Basis(n, sums, values, components, trace)


def _deviations(x: np.ndarray, basis: Basis) -> list[int | None]:
    """Sum of (n x - S)^2 over the entries; None where it is no long."""
    sums = np.array(basis.sums, object)
    most = basis.n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, basis.sums))
    if most < _LONG:
        y = x * basis.n - sums.astype(np.int64)
        if int(np.abs(y).max(initial=0)) <= isqrt((_LONG - 1) // max(1, x.shape[1])):
            return (y * y).sum(axis=1).tolist()
    y = x.astype(object) * basis.n - sums
    return [int(v) if v < _LONG else None for v in (y * y).sum(axis=1)]


def whiten(rows: DataFrame, how: Whitening | None = None, column: str = "embedding") -> DataFrame:
    """One row per usable row of ``rows`` (vec_id, embedding) and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Fitted on all of them. A component without variance (fewer dimensions or
    different vectors than components) is left out, so equal vectors alone and
    empty tables give no rows. ``deviation`` is null where it exceeds a long,
    which takes millions of vectors. ``identity_error`` is measured on the
    whitened rows. Rows with null ids and repeated rows are kept and count;
    other columns are left out.
    """
    how = how or Whitening()
    vectors = written(usable(rows, how, column), "vectors")
    basis = fit(vectors, how)
    count = min(how.components, len(basis.values))
    if count == 0:
        empty = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return rows.sparkSession.createDataFrame([], empty)
    means = np.array([s // basis.n for s in basis.sums], np.int64)
    rests = np.array([float(Fraction(s % basis.n, basis.n)) for s in basis.sums])
    turn = basis.vectors[:, :count] / np.sqrt(basis.values[:count])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                z = ((x - means).astype(float) - rests) @ turn
                arrays = [batch.column("vec_id"), pa.array(_deviations(x, basis), pa.int64()), pa.array(list(z), pa.list_(pa.float64()))]
                yield pa.record_batch(arrays, names=["vec_id", "deviation", "z"])

    projected = written(map_arrow(vectors, project, "vec_id long, deviation long, z array<double>"), "whitened")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count + 1, count))
        for batch in batches:
            z = np.asarray(batch.column("z").flatten().to_numpy(zero_copy_only=False)).reshape(-1, count)
            total[0] += z.sum(axis=0)
            total[1:] += z.T @ z  # the rows were centred before they were turned
        yield pa.record_batch([pa.array(range(total.size), pa.int64()), pa.array(total.ravel())], names=["place", "value"])

    sums = map_arrow(projected.select("z"), moments, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).orderBy("place")
    total = np.array([r["value"] for r in sums.collect()]).reshape(count + 1, count) / basis.n
    covariance = total[1:] - np.outer(total[0], total[0])
    error = float(np.abs(covariance - np.eye(count)).max())
    explained = F.array(*[F.lit(float(v / basis.trace)) for v in basis.values[:count]])
    each = projected.select("vec_id", "deviation", F.posexplode("z").alias("k", "whitened"))
    return each.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(basis.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
