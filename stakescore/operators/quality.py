"""Data-quality checks on the source panel and on the labelled sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stakescore.operators.chunked import adjacent_gaps
from stakescore.schemas import HEIGHT, KEY


def key_violations(df: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Keys that are null or not unique, with their number of rows."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(missing | (F.col("copies") > 1))


def height_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min(HEIGHT).alias("min_height"), F.max(HEIGHT).alias("max_height"))


def distinct_blocks(df: DataFrame) -> DataFrame:
    return df.select(HEIGHT).distinct()


def block_gaps(df: DataFrame, stride: int = 1) -> DataFrame:
    """Neighbouring heights that are not ``stride`` apart."""
    return adjacent_gaps(df).filter(F.col("gap") != stride)


def stride_histogram(df: DataFrame) -> DataFrame:
    """How often each step between neighbouring heights occurs."""
    return adjacent_gaps(df).groupBy("gap").agg(F.count("*").alias("pairs"))


def label_counts(df: DataFrame) -> DataFrame:
    """Rows and distinct heights."""
    per_height = df.groupBy(HEIGHT).agg(F.count("*").alias("_rows"))
    return per_height.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"), F.count(HEIGHT).alias("heights")
    )


def expected_buckets(
    df: DataFrame, vote_proposed_win_size: int, combine_win_size: int, label_win_size: int
) -> DataFrame:
    """Buckets a validator without gaps should get from the panel's height range."""
    first = F.col("min_height") + vote_proposed_win_size - 1
    last = F.col("max_height") - label_win_size - combine_win_size
    buckets = (last - first).cast("double") / F.lit(float(combine_win_size)) + 1
    return height_bounds(df).select(
        "min_height", "max_height", buckets.alias("buckets"), F.floor(buckets).alias("whole_buckets")
    )
