"""Incremental runs: overlapping height batches, resume point and idempotent append.

Labels look ahead by a validator's rows, which has no event-time form, so increments are bounded
runs over the panel and not a stream.

Batches are independent: each numbers a validator's buckets from its own first warm row. On a panel without
gaps their bucket starts meet; where validators miss heights, the buckets of neighbouring batches overlap or
leave out rows. ``incremental_labels`` has no such seams: it goes on, validator by validator, from the last
bucket that the sink holds, and so adds up to the labels of the whole history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stakescore.operators import labeling
from stakescore.operators.chunked import CHUNK
from stakescore.operators.quality import distinct_blocks, height_bounds
from stakescore.params import ScoringParams
from stakescore.plans import data_scoring as plans
from stakescore.schemas import BLOCK_LABEL_SCHEMA, HEIGHT, KEY, OPERATOR, project
from stakescore.staging import Stage, written


@dataclass(frozen=True)
class BatchPlan:
    """Inclusive height batches ``[start + i * stride, ... + batch_size - 1]`` for ``i < whole``, then perhaps
    one shorter batch ending at ``tail_end``. Consecutive batches overlap by the vote and label windows.
    """

    start: int
    stride: int
    batch_size: int
    whole: int
    tail_end: int | None
    vote_proposed_win_size: int
    combine_win_size: int
    label_win_size: int

    @staticmethod
    def of(
        start_block: int,
        global_end_block: int,
        batch_size: int,
        vote_proposed_win_size: int,
        combine_win_size: int,
        label_win_size: int,
        min_block: int,
        strict: bool = False,
    ) -> BatchPlan:
        """``strict`` also skips a tail that would label exactly one bucket."""
        v, c, ahead = vote_proposed_win_size, combine_win_size, label_win_size
        if batch_size < v + c + ahead:
            raise ValueError("batch_size must hold the vote, combine and label windows")
        if ahead % c:
            raise ValueError("label_win_size must be a multiple of combine_win_size")
        if (batch_size - v + 1) % c:
            raise ValueError("batch_size - vote_proposed_win_size + 1 must be a multiple of combine_win_size")
        first = max(min_block, start_block - v + 1)
        stride = batch_size - v - ahead + 1
        whole, tail_end = 0, None
        if start_block <= global_end_block:
            room = global_end_block - (first + batch_size - 1)
            whole = room // stride + 1 if room >= 0 else 0
            tail_start = first + whole * stride
            warm = global_end_block - tail_start + 1 - (v - 1)
            size = warm // c * c + v - 1
            if size >= v + c + ahead - (0 if strict else 1):
                tail_end = tail_start + size - 1
        return BatchPlan(first, stride, batch_size, whole, tail_end, v, c, ahead)

    @property
    def count(self) -> int:
        return self.whole + (self.tail_end is not None)

    def _end(self, batch):
        end = F.lit(self.start + self.batch_size - 1).cast("bigint") + batch * self.stride
        return end if self.tail_end is None else F.when(batch < self.whole, end).otherwise(F.lit(self.tail_end))

    def frame(self, spark: SparkSession) -> DataFrame:
        """(batch_id, batch_start, batch_end)."""
        batch = F.col("id")
        return spark.range(self.count).select(
            batch.alias("batch_id"),
            (F.lit(self.start).cast("bigint") + batch * self.stride).alias("batch_start"),
            self._end(batch).cast("bigint").alias("batch_end"),
        )

    def assign(self, panel: DataFrame) -> DataFrame:
        """Every row once per batch that holds its height, as ``batch_id``. The batches of a height follow
        from arithmetic, so nothing is joined or shuffled.
        """
        if not self.count:
            return panel.withColumn("batch_id", F.lit(0).cast("bigint")).limit(0)
        last_end = self.tail_end or self.start + (self.whole - 1) * self.stride + self.batch_size - 1
        height = F.col(HEIGHT).cast("bigint")
        reached = F.floor((height - self.start) / F.lit(self.stride))
        left = F.floor((height - self.start - self.batch_size) / F.lit(self.stride))
        first = F.greatest(left + 1, F.lit(0)).cast("bigint")
        last = F.least(reached, F.lit(self.count - 1)).cast("bigint")
        return (
            panel.filter(F.col(HEIGHT).between(self.start, last_end))
            .withColumn("batch_id", F.explode(F.when(first <= last, F.sequence(first, last))))
            .filter(F.col(HEIGHT) <= self._end(F.col("batch_id")))
        )


def batch_coverage(plan: BatchPlan, panel: DataFrame) -> DataFrame:
    """Per batch: the first and last height it labels, the number of labelled buckets of a validator without
    gaps, and how many of those bucket starts the panel has.
    """
    v, c, ahead = plan.vote_proposed_win_size, plan.combine_win_size, plan.label_win_size
    warm = F.col("batch_end") - F.col("batch_start") - v + 2
    labelled = F.floor(warm / F.lit(c)) - ahead // c
    batches = plan.frame(panel.sparkSession).select(
        "*",
        (F.col("batch_start") + v - 1).alias("first_label"),
        labelled.alias("buckets"),
    ).withColumn("last_label", F.col("first_label") + (F.col("buckets") - 1) * c)
    starts = batches.select(
        "batch_id", F.explode(F.sequence("first_label", "last_label", F.lit(c).cast("bigint"))).alias("_start")
    )
    heights = distinct_blocks(panel).select(F.col(HEIGHT).cast("bigint").alias("_start"), F.lit(1).alias("_hit"))
    present = (
        starts.join(heights, "_start", "left").groupBy("batch_id").agg(F.count("_hit").alias("present_buckets"))
    )
    return batches.join(present, "batch_id")


def rows_before_batches(plan: BatchPlan, panel: DataFrame) -> DataFrame:
    """(batch_id, operator_address, rows_before): a validator's rows below each batch that follows one of them.

    Rows are counted between neighbouring batch starts first, map-side, so that at most a row for each
    validator and batch is summed up.
    """
    span = F.floor((F.col(HEIGHT).cast("bigint") - plan.start) / F.lit(plan.stride)) + 1  # 0 below the first batch
    spans = (
        panel.select(OPERATOR, F.greatest(span, F.lit(0)).cast("bigint").alias("batch_id"))
        .groupBy(OPERATOR, "batch_id").agg(F.count("*").alias("n"))
    )
    upto = Window.partitionBy(OPERATOR).orderBy("batch_id")
    counted = spans.select(
        OPERATOR, "batch_id", F.sum("n").over(upto).alias("rows_before"), F.lead("batch_id").over(upto).alias("next"),
    )
    # The count holds for every batch up to the next span that has rows.
    last = F.least(F.coalesce(F.col("next") - 1, F.lit(plan.count - 1)), F.lit(plan.count - 1))
    return counted.filter(F.col("batch_id") <= last).select(
        F.explode(F.sequence("batch_id", last)).alias("batch_id"), OPERATOR, "rows_before"
    )


def batched_scoring(
    panel: DataFrame,
    plan: BatchPlan,
    params: ScoringParams,
    stage: Stage = written,
    top: DataFrame | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """Labelled buckets of every batch, each scored on its own rows, in one job. The top set is that of the
    survey window on the whole panel, computed once.

    Activity sums and block totals are those of the whole panel, as a row that is warm in a batch has its
    activity window there. So rows are given to batches only after the wide shuffle, and only those of the
    validators kept; of the others the key and the activity, for the largest of each block.
    """
    if not plan.count:
        panel = panel.limit(0)
    kept, everyone = plans.activity_of(panel, params, stage, top, chunk)
    before = stage(rows_before_batches(plan, panel), "batch-rows")

    def warm(rows: DataFrame) -> DataFrame:
        own = F.col("_position") - F.coalesce("rows_before", F.lit(0))
        in_batches = plan.assign(rows.filter("_complete")).join(before, ["batch_id", OPERATOR], "left")
        return in_batches.filter(own >= params.vote_proposed_win_size).drop("rows_before")

    largest = plans.largest_activity(warm(everyone.select(*KEY, "_activity", "_position", "_complete")), ["batch_id"])
    blocks = stage(plans.block_values(plans.total_values(panel), largest, params), "blocks")
    scored = stage(plans.scored_rows(warm(kept), blocks, params, ["batch_id"]), "scored")
    return plans.labels_of(scored, params, ["batch_id"], chunk)


def covers(panel: DataFrame, end_block: int) -> DataFrame:
    """(max_height, covered): whether the source reaches ``end_block``."""
    return height_bounds(panel).select("max_height", (F.col("max_height") >= end_block).alias("covered"))


def resume_point(sink: DataFrame, panel: DataFrame, start_block: int, combine_win_size: int) -> DataFrame:
    """(resume_start, global_end): the first unlabelled bucket after what the sink holds, or ``start_block``
    for an empty sink, and the panel's last height.
    """
    done = sink.agg(F.max(HEIGHT).alias("_last"))
    end = panel.agg(F.max(HEIGHT).alias("_end"))
    return done.select(
        F.coalesce(F.col("_last") + combine_win_size, F.lit(start_block)).alias("resume_start"),
        end.scalar().alias("global_end"),
    )


def append_dedup(new: DataFrame, sink: DataFrame) -> DataFrame:
    """The rows whose key the sink does not hold yet."""
    return new.join(sink.select(*KEY), list(KEY), "left_anti")


def label_starts(panel: DataFrame, sink: DataFrame, params: ScoringParams) -> DataFrame:
    """(operator_address, start, labelled) of the validators that may get a label.

    Those in the sink go on at their last labelled bucket, the others begin at their first row. Validators
    with too few rows for a label from there on are left out. Of the panel only the key is read.
    """
    held = sink.groupBy(OPERATOR).agg(F.max(HEIGHT).alias("last"))
    from_last = F.col("last").isNull() | (F.col(HEIGHT) >= F.col("last"))
    rows = panel.select(*KEY).join(held, OPERATOR, "left").filter(from_last).groupBy(OPERATOR).agg(
        F.min(HEIGHT).alias("start"), F.max("last").isNotNull().alias("labelled"), F.count("*").alias("n")
    )
    # A label needs rows in the bucket `label_win_size` rows ahead; of the labelled bucket there is one already.
    warm_up = F.when(F.col("labelled"), params.combine_win_size).otherwise(params.vote_proposed_win_size - 1)
    return rows.filter(F.col("n") > warm_up + params.label_win_size).select(OPERATOR, "start", "labelled")


def incremental_labels(
    panel: DataFrame,
    sink: DataFrame,
    end_block: int,
    params: ScoringParams,
    top: DataFrame | None = None,
    stage: Stage = written,
    chunk: int = CHUNK,
    whole_buckets: bool = True,
) -> DataFrame:
    """The ``block_label`` rows that the sink lacks up to ``end_block``; with all increments the sink holds what
    one run over the whole history gives, whatever heights the validators miss.

    The panel is read from the earliest start of a validator that may get a label, and one activity window
    before it; of older rows only their number by validator counts. A label that depends on a bucket that is
    not yet full is left to a later increment, unless ``whole_buckets`` is false (for the last one).
    ``top`` (``operator_address``) must be the same for all increments; without it the survey's top set is
    taken, so the panel must reach the survey's end. Append the result with ``sources.jdbc.upload`` or
    ``append_labels``; repeating an increment then adds nothing.
    """
    bounds = height_bounds(panel).first()
    if bounds.max_height is None or bounds.max_height < end_block:
        raise ValueError(f"end block {end_block} is beyond the source's last block {bounds.max_height}")
    panel = panel.filter(F.col(HEIGHT) <= end_block)
    if top is None and params.top_validators is not None:
        top = plans.survey(panel, params, stage, chunk)
    starts = label_starts(panel, sink, params)
    if top is not None:
        starts = starts.join(stage(top, "top").select(OPERATOR), OPERATOR, "left_semi")
    starts = stage(starts, "starts")
    first = starts.agg(F.min("start")).first()[0]
    if first is None:
        return _no_labels(panel)
    low = first - params.vote_proposed_win_size + 1
    recent, older = panel.filter(F.col(HEIGHT) >= low), plans.rows_until(panel, low)
    warm = plans.eligible(params) & (F.col(HEIGHT) >= first)
    everyone = plans.activity_rows(recent, params, (), chunk, older).filter(warm)
    blocks = stage(plans.block_values(
        plans.total_values(recent.filter(F.col(HEIGHT) >= first)), plans.largest_activity(everyone), params
    ), "blocks")
    own = recent.join(starts.select(OPERATOR), OPERATOR, "left_semi")
    kept = plans.activity_rows(own, params, chunk=chunk, rows_before=older).filter(warm).join(starts, OPERATOR)
    rows = kept.filter(F.col(HEIGHT) >= F.col("start")).drop("start", "labelled")
    scored = stage(plans.scored_rows(rows, blocks, params), "scored")
    buckets = labeling.combine_data(scored, params.combine_win_size, chunk=chunk, rows="_rows")
    if whole_buckets:
        buckets = buckets.filter(F.col("_rows") == params.combine_win_size)
    labelled = labeling.shifting_data(buckets.drop("_rows"), params.label_win_size, params.combine_win_size)
    fresh = labelled.join(starts.select(OPERATOR, "labelled"), OPERATOR).filter(
        ~F.col("labelled") | (F.col("new_block") > 0)
    )
    return append_dedup(project(fresh, BLOCK_LABEL_SCHEMA), sink.filter(F.col(HEIGHT) >= first))


def _no_labels(panel: DataFrame) -> DataFrame:
    return panel.sparkSession.createDataFrame([], BLOCK_LABEL_SCHEMA)


def append_labels(panel: DataFrame, path: str, end_block: int, params: ScoringParams, **settings) -> None:
    """One increment: read the Parquet sink at ``path`` (which may not exist yet), label, append."""
    spark = panel.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        sink = spark.read.schema(BLOCK_LABEL_SCHEMA).parquet(path)
    else:
        sink = _no_labels(panel)
    labels = written(incremental_labels(panel, sink, end_block, params, **settings), "labels")
    labels.write.mode("append").parquet(path)
