"""The scoring run with an account of its rows: how many were dropped, and why.

Every row of the validators that are labelled ends in exactly one cause or in a labelled bucket, so the numbers add up to ``rows``. They are
observed while the run writes its staged tables, without another read of the panel. Each observation sits behind the
last shuffle of the job that writes, whose partitions count once each, also when a lost executor's tasks run again.

Causes, in the order in which they are looked for:

- ``null_<column>``: the first column without a value (or with NaN) among ``LABEL_COLUMNS``; ``null_flags``: no ``jailed`` or ``status``;
- ``not_warm``: fewer rows before it than the activity window asks for;
- ``dead_block``: its block has no tokens or nobody above the self-bond limit, so there are no scores;
- ``no_horizon``: its bucket's label looks at buckets that are not there, or that have no score;
- ``null_bucket``: its bucket lacks another value;
- ``labelled``: its bucket has a label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from stakescore.functions import scores
from stakescore.operators import labeling
from stakescore.operators.chunked import CHUNK, Layout, forward_mean
from stakescore.params import ScoringParams
from stakescore.plans import data_scoring as plans
from stakescore.schemas import OPERATOR
from stakescore.staging import written


def causes() -> list[str]:
    return [f"null_{c}" for c in plans.LABEL_COLUMNS] + ["null_flags", "not_warm", "dead_block", "no_horizon", "null_bucket", "labelled"]


def _null_cause() -> Column:
    """The name of the first cause that a row of ``activity_rows`` is not complete for, or null."""
    cause = F.when(F.lit(False), F.lit(""))
    for c in plans.LABEL_COLUMNS:
        cause = cause.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), F.lit(f"null_{c}"))
    return cause.when(~F.col("_complete"), F.lit("null_flags"))


def accounted_scoring(
    panel: DataFrame, params: ScoringParams, top: DataFrame | None = None, chunk: int = CHUNK, layout: Layout | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """``plans.data_scoring``, staged, and its account: ``rows`` and the number of rows of each of :func:`causes`."""
    kept, everyone = plans.activity_of(panel, params, written, top, chunk, layout)
    all_rows = panel if layout is None else layout.at_home(panel)
    largest = plans.largest_activity(everyone.filter(plans.eligible(params)))
    blocks = written(plans.block_values(plans.total_values(all_rows), largest, params), "blocks")

    met = Observation()
    cause = F.col("_cause")
    seen = kept.withColumn("_cause", F.coalesce(_null_cause(), F.when(~plans.eligible(params), F.lit("not_warm"))))
    nulls = [F.count_if(cause == c).alias(c) for c in causes() if c.startswith("null_") and c != "null_bucket"]
    rows = written(
        seen.observe(met, F.count("*").alias("rows"), F.count_if(cause.isNull()).alias("_eligible"),
                     F.count_if(cause == "not_warm").alias("not_warm"), *nulls)
        .filter(plans.eligible(params)).drop("_cause"), "eligible")

    lived = Observation()
    scored = written(plans.scored_rows(rows, blocks, params).observe(lived, F.count("*").alias("rows")), "scored")

    ended = Observation()
    buckets = labeling.combine_data(scored, params.combine_win_size, chunk=chunk, rows="_rows")
    ahead = params.label_win_size // params.combine_win_size
    found = forward_mean(buckets, "score", ahead, [OPERATOR], "new_block", "label")
    values = [c for c in found.columns if c not in ("label", "_rows")]
    whole = scores.complete(found, values)
    last = F.when(F.col("label").isNull(), F.lit("no_horizon")).when(~whole, F.lit("null_bucket")).otherwise(F.lit("labelled"))
    counted = found.withColumn("_last", last).observe(
        ended, *[F.sum(F.when(F.col("_last") == c, F.col("_rows")).otherwise(0)).alias(c) for c in ("no_horizon", "null_bucket", "labelled")])
    labels = written(counted.drop("_last").na.drop().drop("_rows", "new_block"), "labels")

    first, alive, final = ({k: v or 0 for k, v in seen.get.items()} for seen in (met, lived, ended))
    number = first | final | {"dead_block": first["_eligible"] - alive["rows"]}
    return labels, {"rows": first["rows"]} | {c: number[c] for c in causes()}


def frame(spark: SparkSession, account: dict[str, int]) -> DataFrame:
    """(cause, rows): an account as a table, to be appended to a log of runs."""
    return spark.createDataFrame(list(account.items()), "cause string, rows bigint")
