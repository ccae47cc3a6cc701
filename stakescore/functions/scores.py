"""Score formulas as Column expressions.

All divisions are ``try_divide``: a zero denominator gives null, also under ANSI mode.
Integer and decimal types matter: ``decimal(38,0) / decimal(38,0)`` is ``decimal(38,6)``,
rounded half up, and the double formulas build on that rounded value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

RATE_UNIT = 1e18


def unscaled_rate(rate: Column) -> Column:
    return rate.cast("double") / F.lit(RATE_UNIT)


def flag(value: Column) -> Column:
    """Boolean to 0/1, null stays null."""
    return value.cast("int")


def flag_or_zero(value: Column) -> Column:
    return F.coalesce(flag(value), F.lit(0))


def token_share(tokens: Column, block_total: Column) -> Column:
    return F.try_divide(tokens, block_total)


def voting_power(share: Column, validators: Column) -> Column:
    """1 at share 0, 1/2 at the equal share, 0 above twice the equal share."""
    equal_share = F.try_divide(F.lit(1), validators)
    return F.when(share > 2 * equal_share, F.lit(0.0)).otherwise(1 - F.try_divide(share, equal_share) / 2)


def commission(rate: Column, accept_rate: float) -> Column:
    limit = F.lit(float(accept_rate))
    return F.when(rate > limit, F.lit(0.0)).otherwise(1 - F.try_divide(rate, limit))


def bond_excess(self_bonded: Column, block_total: Column, validators: Column, concentration_level: float) -> Column:
    """Self-bond above the block's mean over ``concentration_level``, never below 0; null stays null.

    Non-decreasing in ``self_bonded``, so the block's largest excess is the excess of its largest self-bond.
    """
    mean = F.try_divide(block_total, validators)
    excess = self_bonded - F.try_divide(mean, F.lit(float(concentration_level)))
    return F.when(excess < 0, F.lit(0.0)).otherwise(excess)


def activity_points(vote: Column, propose: Column, vote_score: int, propose_score: int) -> Column:
    return vote * F.lit(vote_score) + propose * F.lit(propose_score)


def weighted_score(weights: tuple[int, int, int, int], parts: tuple[Column, Column, Column, Column]) -> Column:
    return reduce(lambda x, y: x + y, [F.lit(w) * part for w, part in zip(weights, parts, strict=True)])


def inactive(jailed: Column, status: Column) -> Column:
    """Jailed, or a status holding ``UNBONDED`` (``UNBONDING`` does not)."""
    return F.coalesce(jailed == 1, F.lit(False)) | F.coalesce(status.contains("UNBONDED"), F.lit(False))


def overridden_score(score: Column, is_inactive: Column) -> Column:
    return F.when(is_inactive, F.lit(0.0)).otherwise(score)


def complete(df: DataFrame, columns: list[str]) -> Column:
    """True where ``df.na.drop(subset=columns)`` would keep the row: no null and no NaN."""
    def present(name: str) -> Column:
        value = F.col(name)
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            return value.isNotNull() & ~F.isnan(value)
        return value.isNotNull()

    return reduce(lambda x, y: x & y, [present(name) for name in columns])
