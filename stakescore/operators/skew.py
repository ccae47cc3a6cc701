"""Attaching per-key values to rows when one key may hold much of the table.

A window over the key would put a whole key into one task. Here the values are aggregated first
(with map-side combine) and joined back, and the rows of heavy keys are spread over several
shuffle partitions: a heavy key's value row is repeated once per part.

Adaptive skew joins do not do this job: they only split a shuffle that feeds the join directly, and
the value side of an aggregate-and-join-back has the aggregate in between.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Rows of one key that a single task takes. Of N rows fewer than N / ROWS_PER_PART keys can be heavier, which
#: bounds the list of them that is broadcast: a million narrow rows for a panel of 10^12 rows.
ROWS_PER_PART = 1_000_000


def parts_of(weight: Column, rows_per_part: int) -> Column:
    return F.ceil(weight / F.lit(rows_per_part)).cast("int")


def heavy_keys(values: DataFrame, keys: Sequence[str], weight: str, rows_per_part: int) -> DataFrame:
    """All keys above ``rows_per_part`` rows, with their number of parts."""
    return values.filter(F.col(weight) > rows_per_part).select(
        *keys, parts_of(F.col(weight), rows_per_part).alias("_parts")
    )


def attach_by_key(
    rows: DataFrame,
    values: DataFrame,
    keys: Sequence[str],
    weight: str,
    spread_by: Sequence[str],
    how: str = "inner",
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Equi-join ``rows`` with ``values`` (one row per key), splitting heavy keys.

    ``weight`` is the column of ``values`` that counts a key's rows; it is not in the result.
    ``spread_by`` are columns of ``rows`` that vary within a key. ``how`` is inner, left or left_semi.
    """
    keys = list(keys)
    heavy = F.broadcast(heavy_keys(values, keys, weight, rows_per_part))
    parts = F.col("_parts")
    part = F.when(parts.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*spread_by), parts).cast("int"))
    every_part = F.sequence(F.lit(0), F.greatest(parts_of(F.col(weight), rows_per_part) - 1, F.lit(0)))

    spread = rows.join(heavy, keys, "left").withColumn("_part", part).drop("_parts")
    repeated = values.withColumn("_part", F.explode(every_part)).drop(weight)
    return spread.join(repeated, [*keys, "_part"], how).drop("_part")
