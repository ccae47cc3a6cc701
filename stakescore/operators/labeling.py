"""Top validators, buckets and the forward label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stakescore.operators.chunked import CHUNK, LABEL_CHUNK, forward_mean, row_numbers
from stakescore.operators.skew import attach_by_key
from stakescore.schemas import BLOCK_LABEL_SCHEMA, HEIGHT, KEY, OPERATOR
from stakescore.staging import Stage, lazy

#: The averaged columns of a bucket: those of the label table but for its key and the label.
BUCKET_MEANS = tuple(c for c in BLOCK_LABEL_SCHEMA.fieldNames() if c not in (*KEY, "label"))
#: Largest top set that is broadcast; a larger one is joined by shuffle, with the same result.
BROADCAST_TOP = 100_000


def survey_top(df: DataFrame, start_block: int, end_block: int, top_validators: int) -> DataFrame:
    """(operator_address, mean_score) of the best mean scores within the inclusive survey window; ties go
    to the smaller address.
    """
    return (
        df.filter(F.col(HEIGHT).between(start_block, end_block))
        .groupBy(OPERATOR)
        .agg(F.avg("score").alias("mean_score"))
        .orderBy(F.col("mean_score").desc_nulls_last(), OPERATOR)
        .limit(top_validators)
    )


def keep_validators(df: DataFrame, top: DataFrame, size: int) -> DataFrame:
    """Rows of the validators in ``top``, which has at most ``size`` rows."""
    names = top.select(OPERATOR)
    if size <= BROADCAST_TOP:
        return df.join(F.broadcast(names), OPERATOR, "left_semi")
    rows_each = df.groupBy(OPERATOR).agg(F.count("*").alias("_weight"))
    return attach_by_key(df, rows_each.join(names, OPERATOR, "left_semi"), [OPERATOR], "_weight", [HEIGHT], "left_semi")


def validator_filter(
    df: DataFrame, start_block: int, end_block: int, top_validators: int, stage: Stage = lazy
) -> DataFrame:
    """Keep the whole history of the survey window's top validators."""
    top = stage(survey_top(df, start_block, end_block, top_validators), "top")
    return keep_validators(df, top, top_validators)


def combine_data(
    df: DataFrame, combine_win_size: int, scope: Sequence[str] = (), chunk: int = CHUNK, rows: str | None = None
) -> DataFrame:
    """Means over every ``combine_win_size`` consecutive rows of a validator, at their first height.
    ``new_block`` numbers the buckets from 0; a short last bucket is kept. ``rows`` names a column for their
    number of rows.
    """
    counted = [F.count("*").alias(rows)] if rows else []
    numbered = row_numbers(df, [*scope, OPERATOR], "_position", chunk=chunk)
    return (
        numbered
        .withColumn("new_block", F.floor((F.col("_position") - 1) / F.lit(combine_win_size)).cast("bigint"))
        .groupBy(*scope, OPERATOR, "new_block")
        .agg(F.min(HEIGHT).alias(HEIGHT), *[F.avg(c).alias(c) for c in BUCKET_MEANS], *counted)
    )


def shifting_data(
    df: DataFrame,
    label_win_size: int,
    combine_win_size: int,
    scope: Sequence[str] = (),
    chunk: int = LABEL_CHUNK,
) -> DataFrame:
    """Add ``label``, the mean score of the current and the next ``label_win_size / combine_win_size``
    buckets, and drop rows with any null: a validator's last buckets, and those whose far end has no score.
    """
    if label_win_size % combine_win_size:
        raise ValueError("label_win_size must be a multiple of combine_win_size")
    size = label_win_size // combine_win_size
    return forward_mean(df, "score", size, [*scope, OPERATOR], "new_block", "label", chunk).na.drop()
