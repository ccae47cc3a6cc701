"""The whole scoring run: panel -> labelled buckets.

Same results as chaining the operators of ``operators.scoring`` and ``operators.labeling``, in an order
that moves wide rows only for the validators that are kept. Every block value follows from two aggregations
without joins: totals and the largest self-bond come straight off the panel (the largest self-bond excess is
the excess of the largest self-bond), and the largest activity from a pass over keys, points and one flag,
as within a block either no row or every complete warmed-up row survives the null drop. So:

1. all validators' narrow rows are shuffled once, for the largest activity of each block,
2. the survey reads the heights of its window (and one activity window before it) and gives the top set,
3. the panel is read again for the top validators alone, whose activity needs only their own rows, and
   their rows are scored once, staged, bucketed and labelled.

Without a top set there is one pass, over all columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stakescore.functions import scores
from stakescore.operators import labeling, scoring
from stakescore.operators.chunked import CHUNK, Layout, placed_trailing_sum, trailing_sum
from stakescore.params import ScoringParams
from stakescore.staging import Stage, written
from stakescore.schemas import HEIGHT, OPERATOR, PANEL_COLUMNS

#: What a survey needs of a row, besides its key and activity.
SURVEY_COLUMNS = ("tokens", "self_bonded", "commission_rate")
#: What a label needs.
LABEL_COLUMNS = ("tokens", "delegator_shares", "self_bonded", "commission_rate")


def activity_rows(
    panel: DataFrame,
    params: ScoringParams,
    columns: Sequence[str] = LABEL_COLUMNS,
    chunk: int = CHUNK,
    rows_before: DataFrame | None = None,
    layout: Layout | None = None,
) -> DataFrame:
    """The key, ``columns``, ``_activity``, ``_position``, ``_complete`` (no null in the panel's columns) and, if
    there are ``columns``, ``_inactive``. Flags and status end here, so they are not shuffled.

    ``rows_before`` (operator_address, rows_before) counts the validators' rows that ``panel`` leaves out; ``layout`` tells
    how its rows were placed when they were stored.
    """
    place = [] if layout is None else [layout.CHUNK, layout.HOME]
    rows = scoring.clean(panel.select(*PANEL_COLUMNS, *place))
    rows = scoring.vote_points(rows, params.vote_score, params.propose_score).select(
        HEIGHT, OPERATOR, *columns, *place,
        scores.complete(rows, list(PANEL_COLUMNS)).alias("_complete"), "vote_propose_point",
        *[scores.inactive(F.col("jailed"), F.col("status")).alias("_inactive")] * bool(columns),
    )
    terms = (rows, "vote_propose_point", params.vote_proposed_win_size, [OPERATOR], "_activity", "_position")
    if layout is None:
        summed = trailing_sum(*terms, chunk=chunk, rows_before=rows_before)
    else:
        summed = placed_trailing_sum(*terms, layout, rows_before=rows_before)
    return summed.drop("vote_propose_point")


def activity_once(
    panel: DataFrame, params: ScoringParams, columns: Sequence[str] = LABEL_COLUMNS, chunk: int = CHUNK, rows_before: DataFrame | None = None,
) -> DataFrame:
    """:func:`activity_rows`. Where the activity window is at most half a chunk, rows are shuffled with copies of the last heights
    before a chunk, which then are fewer than the expiries of all rows, and ``panel`` is read twice, once for keys only.
    """
    if 2 * params.vote_proposed_win_size > chunk:
        return activity_rows(panel, params, columns, chunk, rows_before)
    layout = Layout(chunk, params.vote_proposed_win_size - 1)
    return activity_rows(layout.place(panel), params, columns, chunk, rows_before, layout)


def eligible(params: ScoringParams) -> Column:
    """Complete and warmed up."""
    return F.col("_complete") & (F.col("_position") >= params.vote_proposed_win_size)


def total_values(panel: DataFrame) -> DataFrame:
    """Per block: its totals and largest self-bond, from the panel alone."""
    return scoring.block_table(panel, scoring.block_totals() | {"_largest_bond": F.max("self_bonded")})


def largest_activity(rows: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Per block the largest activity among the eligible ``rows``; other blocks are left out."""
    return rows.groupBy(*scope, HEIGHT).agg(F.max("_activity").alias("_largest_sum"))


def block_values(totals: DataFrame, largest: DataFrame, params: ScoringParams) -> DataFrame:
    """Per block: totals, largest self-bond excess and largest activity; blocks without any survivor of the
    null drop are left out.
    """
    excess = scores.bond_excess(
        F.col("_largest_bond"),
        F.col("total_self_bonded_amt_per_block"),
        F.col("validators_count_per_block"),
        params.concentration_level,
    )
    alive = totals.withColumn("_largest_excess", excess).drop("_largest_bond").filter(
        (F.col("total_token_amt_per_block") != 0) & (F.col("_largest_excess") > 0)
    )
    return largest.join(alive, HEIGHT)


def scored_rows(rows: DataFrame, blocks: DataFrame, params: ScoringParams, scope: Sequence[str] = ()) -> DataFrame:
    """The per-block score frame of eligible ``rows``: all sub-scores and the score."""
    attached = scoring.attach_by_key(
        rows.drop("_complete", "_position"), blocks, [*scope, HEIGHT], "_weight", [OPERATOR]
    )
    scored = scoring.commission_score(scoring.voting_power_score(attached), params.accept_rate).withColumns({
        "self_bonded_score": F.try_divide(
            scores.bond_excess(
                F.col("self_bonded"),
                F.col("total_self_bonded_amt_per_block"),
                F.col("validators_count_per_block"),
                params.concentration_level,
            ),
            F.col("_largest_excess"),
        ),
        "vote_propose_score": F.try_divide("_activity", "_largest_sum"),
    }).drop("_activity", "_largest_sum", "_largest_excess")
    total = scoring.weighted_total(params.A, params.B, params.C, params.D)
    return scored.withColumn("score", scores.overridden_score(total, F.col("_inactive"))).drop("_inactive")


def rows_until(panel: DataFrame, height: int) -> DataFrame:
    """(operator_address, rows_before): the validators' rows below ``height``, counted map-side."""
    return panel.filter(F.col(HEIGHT) < height).groupBy(OPERATOR).agg(F.count("*").alias("rows_before"))


def survey(panel: DataFrame, params: ScoringParams, stage: Stage = written, chunk: int = CHUNK) -> DataFrame:
    """The top validators of the survey window. Sums are taken over the window and the activity window before
    it; of older rows only the number by validator counts.
    """
    first = params.start_block - params.vote_proposed_win_size + 1
    recent = panel.filter(F.col(HEIGHT).between(first, params.end_block))
    rows = activity_once(recent, params, SURVEY_COLUMNS, chunk, rows_until(panel, first))
    rows = stage(rows.filter(eligible(params) & (F.col(HEIGHT) >= params.start_block)), "survey")
    totals = total_values(panel.filter(F.col(HEIGHT).between(params.start_block, params.end_block)))
    blocks = stage(block_values(totals, largest_activity(rows), params), "survey-blocks")
    return labeling.survey_top(
        scored_rows(rows, blocks, params), params.start_block, params.end_block, params.top_validators
    )


def score_panel(panel: DataFrame, params: ScoringParams, stage: Stage = written, chunk: int = CHUNK) -> DataFrame:
    """Per-block scores of every validator (the ``validator_score`` table, before survey and buckets)."""
    rows = stage(activity_rows(panel, params, chunk=chunk).filter(eligible(params)), "activity")
    return scored_rows(rows, stage(block_values(total_values(panel), largest_activity(rows), params), "blocks"), params)


def activity_of(
    panel: DataFrame, params: ScoringParams, stage: Stage, top: DataFrame | None, chunk: int, layout: Layout | None = None
) -> tuple[DataFrame, DataFrame]:
    """Activity rows of the validators to label, and of all validators; of the latter only the key,
    ``_activity``, ``_position`` and ``_complete`` are to be used.

    ``top`` (``operator_address``, one row each) is labelled instead of the survey's top set; with neither, all.
    """
    size = params.top_validators
    if top is not None:
        top = stage(top, "top")
        size = top.count()
    elif size is not None:
        top = stage(survey(panel if layout is None else layout.at_home(panel), params, stage, chunk), "top")
    if top is None:
        rows = stage(activity_rows(panel, params, chunk=chunk, layout=layout), "activity")
        return rows, rows
    kept = labeling.keep_validators(panel, top, size)
    return (
        activity_rows(kept, params, chunk=chunk, layout=layout),
        activity_rows(panel, params, (), chunk, layout=layout),
    )


def data_scoring(
    panel: DataFrame,
    params: ScoringParams,
    stage: Stage = written,
    top: DataFrame | None = None,
    chunk: int = CHUNK,
    layout: Layout | None = None,
) -> DataFrame:
    """Labelled buckets of the top validators. ``top`` (``operator_address``, one row each) is kept instead of
    the survey's top set. With ``layout``, ``panel`` is ``placed()`` of a stored panel (``sources.layout``), whose
    rows are not shuffled for the activity.
    """
    kept, everyone = activity_of(panel, params, stage, top, chunk, layout)
    largest = largest_activity(everyone.filter(eligible(params)))
    rows = panel if layout is None else layout.at_home(panel)
    blocks = stage(block_values(total_values(rows), largest, params), "blocks")
    scored = stage(scored_rows(kept.filter(eligible(params)), blocks, params), "scored")
    return labels_of(scored, params, chunk=chunk)


def labels_of(scored: DataFrame, params: ScoringParams, scope: Sequence[str] = (), chunk: int = CHUNK) -> DataFrame:
    buckets = labeling.combine_data(scored, params.combine_win_size, scope, chunk)
    return labeling.shifting_data(buckets, params.label_win_size, params.combine_win_size, scope).drop("new_block")
