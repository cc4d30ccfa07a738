"""Whitening of vectors from exact covariances by polarisation.

For every dimension and every sum of two dimensions the squared centred values are added up as whole numbers. As
2 cov(a, b) = var(a + b) - var(a) - var(b), differences of these sums give every covariance exactly, before the first
rounding; the matrix is then taken apart by ``eigh``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches
from riskframe.session import materialise

#: Components that are returned at most.
COMPONENTS = 16
#: Components whose variance is below this part of the largest are noise of the arithmetic and are left out.
NEGLIGIBLE = 1e-10
#: Entries are whole multiples of 1 / SCALE, moved up by OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Whole entries beyond this are an error, as no exact deviation of them fits a long.
LARGEST = 1 << 53
#: Entries that a worker handles at a step.
STEP_ENTRIES = 1 << 18
_HALF = 62


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and x array<bigint> of the rows whose vector is complete and finite."""
    entry = lambda c: c.cast("double")
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(entry(c)) & (F.abs(entry(c)) != float("inf")))
    rows = embeddings.select("vec_id", "embedding").filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).filter(fine)
    large = F.exists("embedding", lambda c: F.abs(entry(c)) * SCALE > LARGEST)
    too_large = F.raise_error(F.lit("an entry is too large for exact deviations"))
    x = F.transform("embedding", lambda c: F.floor(entry(c) * SCALE) + OFFSET)
    return rows.select("vec_id", F.when(large, too_large).otherwise(x).alias("x"))


def _commonest_length(rows: DataFrame) -> int:
    """Number of dimensions that most vectors have, the smaller of equals; 0 without vectors."""
    first = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return first.d if first else 0


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def _blocks(batches, d: int):
    size = max(1, STEP_ENTRIES // d)
    for batch in batches:
        for i in range(0, batch.num_rows, size):
            part = batch.slice(i, size)
            yield part, _matrix(part.column("x"), d)


def square_sums(values: np.ndarray) -> list[int]:
    """The exact sum of squares of each column of whole numbers."""
    values = np.abs(values)
    top = int(values.max(initial=0))
    if top * top * len(values) < 1 << 63:
        return (values * values).sum(axis=0).tolist()
    low, mid, high = values & 0x1FFFFF, values >> 21 & 0x1FFFFF, values >> 42
    sums = [low * low, 2 * low * mid, 2 * low * high + mid * mid, 2 * mid * high, high * high]
    total = [0] * values.shape[1]
    for k, part in enumerate(sums):  # at most 2**44 an entry: those of a step fit
        total = [t + (s << 21 * k) for t, s in zip(total, part.sum(axis=0).tolist())]
    return total


def _summed(rows: DataFrame, make, schema: str, key: list[str]) -> list:
    """Whole numbers that ``make`` adds up in each task, by ``key``; they cross the wire as two halves, as sums of them may
    have more digits than a long. As many rows come back as there are keys."""
    halves = rows.mapInArrow(make, schema)
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    return [(*[r[k] for k in key], (int(r.high) << _HALF) + int(r.low)) for r in halves.groupBy(*key).agg(wide("high"), wide("low")).collect()]


def _halves(totals: list[int]) -> list[pa.Array]:
    return [pa.array([t >> _HALF for t in totals], pa.int64()), pa.array([t & ((1 << _HALF) - 1) for t in totals], pa.int64())]


def dimension_sums(vectors: DataFrame, d: int) -> list[int]:
    """The sum of x in each dimension."""
    def run(batches):
        totals = [0] * d
        for _, x in _blocks(batches, d):
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            totals = [t + (h << 32) + part for t, h, part in zip(totals, high, low)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), *_halves(totals)], names=["dim", "high", "low"])

    found = dict(_summed(vectors, run, "dim int, high bigint, low bigint", ["dim"]))
    return [found.get(i, 0) for i in range(d)]


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, whole; an error where it does not fit. ``sums`` are Python numbers."""
    fits = 1 << 61
    if int(np.abs(x).max(initial=0)) * n < fits and max(map(abs, sums), default=0) < fits:
        return x * n - sums.astype(np.int64)
    out = x.astype(object) * n - sums
    if max(map(abs, out.ravel()), default=0) >= fits:
        raise OverflowError("deviations from the mean do not fit 64 bits")
    return out.astype(np.int64)


def polarised_sums(vectors: DataFrame, d: int, n: int, sums: list[int]) -> dict[tuple[int, int], int]:
    """(a, b) with a < b: the squared centred values of x_a + x_b, times n**2, added up over all vectors; (a, a): those of x_a."""
    at = [(a, b) for a in range(d) for b in range(a, d)]

    def run(batches):
        mean, totals = np.array(sums, object), [0] * len(at)
        for _, x in _blocks(batches, d):
            y = centred(x, n, mean)
            found = []
            for a in range(d):
                pairs = y[:, a:] + y[:, a:a + 1]
                pairs[:, 0] = y[:, a]
                found += square_sums(pairs)
            totals = [t + s for t, s in zip(totals, found)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in at], pa.int32()), pa.array([b for _, b in at], pa.int32()), *_halves(totals)],
            names=["a", "b", "high", "low"])

    found = _summed(vectors, run, "a int, b int, high bigint, low bigint", ["a", "b"])
    return {(a, b): total for a, b, total in found}


def covariance(squares: dict[tuple[int, int], int], d: int, n: int) -> np.ndarray:
    """The covariance matrix, each entry rounded once."""
    v = np.zeros((d, d))
    for (a, b), total in squares.items():
        v[a, b] = v[b, a] = total / n ** 3 if a == b else (total - squares[a, a] - squares[b, b]) / (2 * n ** 3)
    return v


@dataclass
class Whitening:
    """Fitted on ``n`` distinct vectors of ``d`` dimensions with sums ``sums``; ``directions`` d x k are unit eigenvectors,
    ``variances`` their eigenvalues, ``explained`` their parts of all variance."""

    d: int
    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened components of centred values n * x - S."""
        return (y / self.n) @ self.directions / np.sqrt(self.variances)


def fit(vectors: DataFrame, d: int, n: int, components: int = COMPONENTS) -> Whitening:
    """The largest ``components`` of the distinct ``vectors`` (x), all of ``d`` dimensions. The largest entry by size of each
    direction is positive. Two passes over the vectors; sums for d * (d + 1) / 2 pairs come to the driver."""
    sums = dimension_sums(vectors, d)
    v = covariance(polarised_sums(vectors, d, n, sums), d, n)
    found, directions = np.linalg.eigh(v)
    order = np.argsort(-found, kind="stable")[:components]
    order = order[found[order] > NEGLIGIBLE * max(found.max(), 0)]
    directions = directions[:, order]
    signs = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(len(order))])
    return Whitening(d, n, sums, directions * signs, found[order], found[order] / np.trace(v) if len(order) else found[order])


def identity_error(vectors: DataFrame, fitted: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened vectors minus the identity.

    Measured on the vectors: products are added up in each task, then as whole multiples of 1e-12.
    """
    k, unit = len(fitted.variances), 1e12

    def run(batches):
        total, mean = np.zeros((k, k)), np.array(fitted.sums, object)
        for _, x in _blocks(batches, fitted.d):
            w = fitted.project(centred(x, fitted.n, mean))
            total += w.T @ w
        flat = [round(t * unit) for t in total.ravel().tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int32()), *_halves(flat)], names=["at", "high", "low"])

    found = _summed(vectors, run, "at int, high bigint, low bigint", ["at"])
    entries = np.zeros(k * k)
    for at, total in found:
        entries[at] = total / int(unit) / fitted.n
    return float(np.abs(entries.reshape(k, k) - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for every vector and component.

    Rows whose ``embedding`` is null, empty or holds null, NaN or infinity take no part. Nor do vectors of another length than
    the commonest (of equals the shorter): they have no place in its space. Repeated rows and null ids are kept, and an x
    vector counts once for the fit however often it occurs. Components with a variance below NEGLIGIBLE of the largest are
    left out, so a table without two different vectors gives no rows. Entries above 2**53 / 64 by size, or deviations that do
    not fit 64 bits, are an error. Other columns are ignored.
    """
    small_batches(embeddings.sparkSession)
    rows = materialise(whole_vectors(embeddings), "whole-vectors")
    d = _commonest_length(rows)
    rows = rows.filter(F.size("x") == d)
    vectors = materialise(rows.select("x").distinct(), "distinct-vectors")
    n = vectors.count()
    schema = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    if n == 0:
        return rows.sparkSession.createDataFrame([], schema)
    fitted = fit(vectors, d, n, components)
    k = len(fitted.variances)
    if k == 0:
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(vectors, fitted)

    def run(batches):
        mean = np.array(fitted.sums, object)
        for part, x in _blocks(batches, d):
            y = centred(x, n, mean)
            w = fitted.project(y)
            m = len(w)
            repeat = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id").take(repeat), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)), pa.array(square_sums(y.T), pa.int64()).take(repeat), pa.array(w.ravel()),
                pa.array(np.tile(fitted.explained, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, schema)
