"""What the operators on vectors share: which rows take part, whole-number components, exact sums."""

from __future__ import annotations

import decimal
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Scaled components beyond this count as this, so that sums of up to 2^55 of them fit 38 decimal digits.
LARGEST = 2.0**70
#: Below this, squares of differences of 128 components fit 64 bits.
NARROW = 1 << 26


def finite(rows: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector is not null and holds no null, NaN or infinite component."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return rows.filter(F.col(vector).isNotNull() & F.coalesce(sound, F.lit(False)))


def usual_length(rows: DataFrame, vector: str) -> int:
    """The most frequent number of components (of several the smallest); 0 without rows."""
    most = rows.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), "size").first()
    return most["size"] if most else 0


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def whole(values: np.ndarray, scale: float, shift: int = 0) -> np.ndarray:
    """floor(scale * values) + shift, exact: 64-bit integers, or Python's where those are too narrow."""
    scaled = np.clip(np.floor(values * scale), -LARGEST, LARGEST)
    if np.abs(scaled).max(initial=0) < NARROW:
        return scaled.astype(np.int64) + shift
    return np.frompyfunc(int, 1, 1)(scaled) + shift


def narrowed(numbers: list | np.ndarray) -> np.ndarray:
    """Whole numbers as 64-bit integers if they are small, else as Python's."""
    numbers = np.asarray(numbers, object)
    small = not numbers.size or max(abs(numbers.min()), abs(numbers.max())) < NARROW
    return numbers.astype(np.int64) if small else numbers


def decimals(numbers) -> pa.Array:
    """Whole numbers for a decimal(38,0) column."""
    return pa.array([decimal.Decimal(int(n)) for n in numbers], pa.decimal128(38, 0))


def longs(numbers: np.ndarray) -> pa.Array:
    """Whole numbers for a long column; null where they exceed it."""
    if numbers.dtype != object:
        return pa.array(numbers, pa.int64())
    return pa.array([n if -(1 << 63) <= n < 1 << 63 else None for n in numbers], pa.int64())


def totals(numbers: np.ndarray) -> np.ndarray:
    """Sums of the rows, as Python integers."""
    return np.array([int(x) for x in numbers.sum(axis=0).ravel()], object)
