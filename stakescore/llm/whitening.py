"""Whitening of vectors by polarisation.

Components become whole numbers. The squares of every centred component, and of the sum of every two centred
components, are summed up exactly. A covariance is half of what the variance of the sum exceeds the sum of the variances by, so
all of them follow from these sums by exact subtraction, and are divided only then. The matrix is assembled on the driver and
decomposed there; rows are projected where they lie.

Numbers are centred in whole units, at the floor m of a component's mean, and the rest is exact too: with u = x - m, S the sum
and r = S - n m (0 <= r < n), the sum of (n x - S)^2 is n^2 sum(u^2) - n r^2.

Three passes without a shuffle of rows: sums; squares; the covariance of what comes out. A task adds up its rows and emits one row for
each component or pair, so what is shuffled is tasks times pairs, and what reaches the driver is a number for each pair,
whatever the number of rows.

Nulls and ties: vectors that are null or hold a null or non-finite component are dropped, and so are those of another length
than the most frequent one. Rows of equal or null id count and are returned each. Directions without variance (fewer rows than
components, constant components) are left out, so a table of one row gives no rows; nor does an empty one. A deviation beyond 64 bits is
null. Columns of any name may be there; only the two named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stakescore import staging
from stakescore.llm.batches import batches_of
from stakescore.llm.vectors import NARROW, decimals, finite, longs, matrix, totals, usual_length, whole

SCALE, SHIFT, COMPONENTS = 64.0, 1_000_000, 32
#: Part of the largest eigenvalue below which a direction has no variance.
FLAT = 1e-12
#: Rows worked on at once; squares of ROWS sums of two components fit 64 bits.
ROWS = 256


def _sums(rows: DataFrame, size: int) -> tuple[int, list[int]]:
    """The number of rows and the sum of each component."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(size, object)
        for batch in batches_of(batches, ROWS):
            count += batch.num_rows
            total += totals(whole(matrix(batch.column("vector"), size), SCALE, SHIFT))
        if count:
            yield pa.record_batch({"place": pa.array(range(-1, size), pa.int32()), "total": decimals([count, *total])})

    found = rows.select("vector").mapInArrow(summed, "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total"))
    by_place = {r["place"]: int(r["total"]) for r in found.collect()}
    return by_place.get(-1, 0), [by_place.get(i, 0) for i in range(size)]


def _fitting(u: np.ndarray) -> np.ndarray:
    """Centred numbers in 64 bits if squares of sums of two fit, else Python's."""
    if u.dtype != object:
        return u if np.abs(u).max(initial=0) < NARROW else u.astype(object)
    return u


def squares(rows: DataFrame, means: list[int], size: int) -> DataFrame:
    """(one, two, total): the sums of u_one^2, where the two are the same, and of (u_one + u_two)^2."""
    centre = np.array(means, object)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, met = [np.zeros(size - i, object) for i in range(size)], False
        for batch in batches_of(batches, ROWS):
            met = True
            u = np.ascontiguousarray(_fitting(_centred(batch, size, centre)).T)
            for i in range(size):
                pairs = u[i] + u[i:]
                pairs[0] = u[i]
                total[i] += totals((pairs * pairs).T)
        for i in range(size if met else 0):
            yield pa.record_batch({
                "one": pa.array(np.full(size - i, i), pa.int32()), "two": pa.array(np.arange(i, size), pa.int32()), "total": decimals(total[i]),
            })

    return rows.select("vector").mapInArrow(summed, "one int, two int, total decimal(38,0)").groupBy("one", "two").agg(F.sum("total").alias("total"))


def _centred(batch: pa.RecordBatch, size: int, centre: np.ndarray) -> np.ndarray:
    """Components less the floors of their means."""
    x = whole(matrix(batch.column("vector"), size), SCALE, SHIFT)
    if x.dtype != object and max(map(abs, centre), default=0) < 1 << 40:
        return x - centre.astype(np.int64)
    return x.astype(object) - centre


def covariance(totals: dict[tuple[int, int], int], rests: list[int], n: int) -> np.ndarray:
    """The covariance matrix: differences of exact variances, each divided once."""
    size = len(rests)

    def variance(total: int, rest: int) -> int:  # times n^2 times n
        return n * (n * total - rest * rest)

    own = [variance(totals[i, i], rests[i]) for i in range(size)]
    out = np.empty((size, size))
    for i in range(size):
        out[i, i] = own[i] / n**3
        for j in range(i + 1, size):
            out[i, j] = out[j, i] = (variance(totals[i, j], rests[i] + rests[j]) - own[i] - own[j]) / (2 * n**3)
    return out


@dataclass
class Whitening:
    """A fitted whitening: ``directions`` by component, already over the roots of the eigenvalues."""

    n: int
    size: int
    means: list[int]  # floors
    rests: list[int]  # sum less n times the floor
    values: np.ndarray
    directions: np.ndarray
    trace: float

    def project(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Whitened rows and the centred whole numbers."""
        u = _centred(batch, self.size, np.array(self.means, object))
        rest = np.array([r / self.n for r in self.rests])
        return (u.astype(np.float64) - rest) @ self.directions, u

    def deviations(self, u: np.ndarray) -> np.ndarray:
        """Exact sums of (n x - S)^2."""
        if u.dtype != object and self.n * (int(np.abs(u).max(initial=0)) + 1) < 1 << 30:
            w = self.n * u - np.array(self.rests, np.int64)  # squares below 2^60
            low, high = w * w & (1 << 32) - 1, w * w >> 32
            return (high.sum(axis=1).astype(object) << 32) + low.sum(axis=1).astype(object)
        w = self.n * u.astype(object) - np.array(self.rests, object)
        return (w * w).sum(axis=1)


def fit(rows: DataFrame, size: int, components: int = COMPONENTS) -> Whitening:
    """Fit to all ``rows`` (vector, of ``size`` components)."""
    n, sums = _sums(rows, size)
    means = [s // n for s in sums]
    rests = [s - n * m for s, m in zip(sums, means)]
    found = {(r["one"], r["two"]): int(r["total"]) for r in squares(rows, means, size).collect()}
    matrix_ = covariance(found, rests, n)
    values, vectors = np.linalg.eigh(matrix_)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > FLAT * max(values.max(initial=0), 0)]
    return Whitening(n, size, means, rests, values[order], vectors[:, order] / np.sqrt(values[order]), float(np.trace(matrix_)))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest entry by which the covariance of the whitened rows differs from the identity, measured on all of them."""
    size = len(model.values)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(size), np.zeros((size, size))
        for batch in batches_of(batches, ROWS * 16):
            white, _ = model.project(batch)
            total += white.sum(axis=0)
            products += white.T @ white
        one, two = np.indices((size + 1, size)).reshape(2, -1)
        yield pa.record_batch({
            "one": pa.array(one, pa.int32()), "two": pa.array(two, pa.int32()), "total": pa.array(np.concatenate([products.ravel(), total])),
        })

    found = rows.select("vector").mapInArrow(summed, "one int, two int, total double").groupBy("one", "two").agg(F.sum("total").alias("total")).collect()
    sums = np.zeros((size + 1, size))
    for r in found:
        sums[r["one"], r["two"]] = r["total"] / model.n
    return float(np.abs(sums[:-1] - np.outer(sums[-1], sums[-1]) - np.eye(size)).max(initial=0))


def whiten(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Per row that takes part and component: vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained
    (the eigenvalue's share of the trace) and identity_error (see :func:`identity_error`).
    """
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    named = finite(vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("vector")), "vector")
    size = usual_length(named, "vector")
    rows = named.filter(F.size("vector") == size)
    model = fit(rows, size, components) if size else None
    if not size or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    wrong, share = identity_error(rows, model), model.values / model.trace
    count = len(share)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, ROWS * 4):
            white, u = model.project(batch)
            m = batch.num_rows
            yield pa.record_batch({
                "vec_id": batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), count))),
                "component": pa.array(np.tile(np.arange(1, count + 1), m), pa.int32()),
                "n": pa.array(np.full(m * count, model.n), pa.int64()),
                "deviation": longs(model.deviations(u)).take(pa.array(np.repeat(np.arange(m), count))),
                "whitened": pa.array(white.ravel()), "explained": pa.array(np.tile(share, m)),
                "identity_error": pa.array(np.full(m * count, wrong)),
            })

    return rows.mapInArrow(projected, schema)
