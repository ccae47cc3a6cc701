"""Step-by-step scoring operators, each DataFrame -> DataFrame.

``scope`` names extra key columns (a batch id) that separate independent panels in one frame.
Keys (scope, block_height, operator_address) must be unique and not null; ``quality.key_violations``
finds those that are not.

Building an operator starts no job. Those that attach block values use their input twice, so the plan of
a chain of them doubles with every step; with ``stage=staging.written`` their block tables are written when
the operator is built, and the chain stays linear. ``plans.data_scoring`` computes the whole chain with
fewer shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stakescore.functions import scores
from stakescore.operators.chunked import CHUNK, Layout, placed_trailing_sum, trailing_sum
from stakescore.operators.skew import attach_by_key
from stakescore.schemas import HEIGHT, OPERATOR
from stakescore.staging import Stage, lazy


def block_totals() -> dict[str, Column]:
    """Aggregates over all rows of a block."""
    return {
        "validators_count_per_block": F.count(OPERATOR),
        "total_token_amt_per_block": F.sum("tokens"),
        "total_self_bonded_amt_per_block": F.sum("self_bonded"),
    }


def block_table(df: DataFrame, aggregates: dict[str, Column], scope: Sequence[str] = ()) -> DataFrame:
    """One row per block with the named aggregates and ``_weight``, its number of rows."""
    return df.groupBy(*scope, HEIGHT).agg(
        F.count("*").alias("_weight"), *[expr.alias(name) for name, expr in aggregates.items()]
    )


def attach_to_blocks(df: DataFrame, blocks: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return attach_by_key(df, blocks, [*scope, HEIGHT], "_weight", [OPERATOR], how="left")


def block_stats(df: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """(block, validator count, total tokens, total self-bond)."""
    return block_table(df, block_totals(), scope).drop("_weight")


def clean(df: DataFrame) -> DataFrame:
    """Unscaled commission rate; jailed/vote/propose as 0/1, a missing vote or propose being 0."""
    return df.withColumns({
        "commission_rate": scores.unscaled_rate(F.col("commission_rate")),
        "jailed": scores.flag(F.col("jailed")),
        "vote": scores.flag_or_zero(F.col("vote")),
        "propose": scores.flag_or_zero(F.col("propose")),
    })


def preprocess(df: DataFrame, scope: Sequence[str] = (), stage: Stage = lazy) -> DataFrame:
    """``clean`` plus the block's validator count, total tokens and total self-bond on every row."""
    return attach_to_blocks(clean(df), stage(block_table(df, block_totals(), scope), "totals"), scope)


def voting_power_score(df: DataFrame) -> DataFrame:
    """Add ``tokens_proportion`` and ``voting_power_score``."""
    shares = df.withColumn(
        "tokens_proportion", scores.token_share(F.col("tokens"), F.col("total_token_amt_per_block"))
    )
    return shares.withColumn(
        "voting_power_score",
        scores.voting_power(F.col("tokens_proportion"), F.col("validators_count_per_block")),
    )


def commission_score(df: DataFrame, accept_rate: float) -> DataFrame:
    return df.withColumn("commission_score", scores.commission(F.col("commission_rate"), accept_rate))


def self_bonded_score(
    df: DataFrame, concentration_level: float, scope: Sequence[str] = (), stage: Stage = lazy
) -> DataFrame:
    """Self-bond excess as a fraction of the block's largest; null where that is 0."""
    largest = stage(block_table(df, {"_largest_bond": F.max("self_bonded")}, scope), "bonds")
    block = (F.col("total_self_bonded_amt_per_block"), F.col("validators_count_per_block"), concentration_level)
    return (
        attach_to_blocks(df, largest, scope)
        .withColumn("self_bonded_score", F.try_divide(
            scores.bond_excess(F.col("self_bonded"), *block),
            scores.bond_excess(F.col("_largest_bond"), *block),
        ))
        .drop("_largest_bond")
    )


def vote_points(df: DataFrame, vote_score: int, propose_score: int) -> DataFrame:
    return df.withColumn(
        "vote_propose_point", scores.activity_points(F.col("vote"), F.col("propose"), vote_score, propose_score)
    )


def moving_vote_sum(
    df: DataFrame, vote_proposed_win_size: int, scope: Sequence[str] = (), chunk: int = CHUNK, layout: Layout | None = None
) -> DataFrame:
    """Add ``vote_propose_score``: the points over the last ``vote_proposed_win_size`` *heights*, null for
    the first ``vote_proposed_win_size - 1`` *rows* of a validator. Gaps lower the sum, not the row count.
    ``layout`` tells how the rows of ``df`` were placed when they were stored.
    """
    terms = (df, "vote_propose_point", vote_proposed_win_size, [*scope, OPERATOR], "_sum", "_position")
    summed = trailing_sum(*terms, chunk=chunk) if layout is None else placed_trailing_sum(*terms, layout)
    warm = F.col("_position") >= vote_proposed_win_size
    return summed.withColumn("vote_propose_score", F.when(warm, F.col("_sum"))).drop("_sum", "_position")


def vote_proposed_score(
    df: DataFrame,
    vote_score: int,
    propose_score: int,
    vote_proposed_win_size: int,
    scope: Sequence[str] = (),
    chunk: int = CHUNK,
    stage: Stage = lazy,
) -> DataFrame:
    """Drop rows with any null (warm-up rows among them) and add the activity sum as a fraction of the
    block's largest among the remaining rows; null where that is 0.
    """
    points = vote_points(df, vote_score, propose_score)
    summed = moving_vote_sum(points, vote_proposed_win_size, scope, chunk).drop("vote_propose_point")
    kept = stage(summed.na.drop(), "sums")
    largest = stage(block_table(kept, {"_largest_sum": F.max("vote_propose_score")}, scope), "largest-sums")
    return (
        attach_to_blocks(kept, largest, scope)
        .withColumn("vote_propose_score", F.try_divide("vote_propose_score", "_largest_sum"))
        .drop("_largest_sum")
    )


def weighted_total(A: int, B: int, C: int, D: int) -> Column:
    parts = ("voting_power_score", "commission_score", "self_bonded_score", "vote_propose_score")
    return scores.weighted_score((A, B, C, D), tuple(F.col(c) for c in parts))


def final_score(df: DataFrame, A: int, B: int, C: int, D: int) -> DataFrame:
    """The weighted sum of the sub-scores; 0 for inactive validators, even where a sub-score is null."""
    inactive = scores.inactive(F.col("jailed"), F.col("status"))
    return df.withColumn("score", scores.overridden_score(weighted_total(A, B, C, D), inactive))
