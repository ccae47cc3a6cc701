"""Registered queries: every operator over the whole weekly panel (or the whole ``events`` table).

Doubles are rounded to six digits, as sums of doubles depend on their order in the last bits; integers and
decimals are shown as they are, in their declared types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType

from stakescore import schemas
from stakescore.catalog.panels import (
    TEST, TEST_BATCH_SIZE, TEST_BUCKETS, TEST_CHUNK, TEST_INCREMENTS, TEST_RUN_CHUNK,
    damaged_panel, minute_heights, weekly_panel,
)
from stakescore.catalog.workdir import give_folder
from stakescore.operators import labeling, quality, scoring
from stakescore.plans import accounting, data_scoring as scoring_plan
from stakescore.staging import staging_path, written
from stakescore.schemas import HEIGHT, KEY
from stakescore.operators.chunked import Layout
from stakescore.sources import files
from stakescore.sources.layout import StoredPanel, buckets_for
from stakescore.incremental import backfill, carried, corrections, runs
from stakescore.incremental.arrivals import Arrivals
from stakescore.incremental.sketches import Sketches

Query = Callable[[SparkSession, str], DataFrame]


#: Takes sums and products of few decimal digits off the middle between two roundings.
NUDGE = 3e-10


def comparable(df: DataFrame) -> DataFrame:
    def column(field):
        if not isinstance(field.dataType, (DoubleType, FloatType)):
            return F.col(field.name)
        value = F.col(field.name).cast("double")  # a rate scaled by 10^18 is a whole number
        return F.when(F.abs(value) < 1e9, F.round(value + NUDGE, 6)).otherwise(value).alias(field.name)

    return df.select([column(f) for f in df.schema])


def _panel(spark, sf_dir):
    """The weekly panel as a table, for plans that read it more than once."""
    return written(weekly_panel(spark, sf_dir), "panel")


def _stored_panel(spark, sf_dir):
    """The weekly panel as a Parquet source under the declared schema."""
    path = staging_path(spark, "source")
    schemas.project(weekly_panel(spark, sf_dir), schemas.PANEL_SCHEMA).write.parquet(path)
    return files.read_panel(spark, path)


def _laid_out(spark, sf_dir) -> StoredPanel:
    """The weekly panel bucketed by validator and chunk, in two loads that share chunks."""
    layout = Layout(TEST_CHUNK, TEST.vote_proposed_win_size - 1)
    panel = _panel(spark, sf_dir)
    stored = StoredPanel.create(spark, staging_path(spark, "laid-out"), layout, buckets_for(panel.count(), TEST_BUCKETS))
    stored.append(panel.filter(F.col(HEIGHT) > TEST_INCREMENTS[0]))
    stored.append(panel.filter(F.col(HEIGHT) <= TEST_INCREMENTS[0]))
    return stored


def _preprocessed(spark, sf_dir):
    return scoring.preprocess(_panel(spark, sf_dir), stage=written)


def _powered(spark, sf_dir):
    return scoring.voting_power_score(_preprocessed(spark, sf_dir))


def _commissioned(spark, sf_dir):
    return scoring.commission_score(_powered(spark, sf_dir), TEST.accept_rate)


def _bonded(spark, sf_dir):
    return scoring.self_bonded_score(_commissioned(spark, sf_dir), TEST.concentration_level, stage=written)


def _active(spark, sf_dir):
    return scoring.vote_proposed_score(
        written(_bonded(spark, sf_dir), "bonded"),
        TEST.vote_score, TEST.propose_score, TEST.vote_proposed_win_size, chunk=TEST_CHUNK, stage=written,
    )


def _scored(spark, sf_dir):
    return scoring.final_score(_active(spark, sf_dir), TEST.A, TEST.B, TEST.C, TEST.D)


def _scores(spark, sf_dir):
    return scoring_plan.score_panel(_panel(spark, sf_dir), TEST, chunk=TEST_CHUNK)


def _kept(spark, sf_dir):
    scored = written(_scores(spark, sf_dir), "scores")
    return labeling.validator_filter(scored, TEST.start_block, TEST.end_block, TEST.top_validators, written)


def _buckets(spark, sf_dir):
    return labeling.combine_data(_kept(spark, sf_dir), TEST.combine_win_size, chunk=TEST_CHUNK)


def _labelled(spark, sf_dir):
    return scoring_plan.data_scoring(_panel(spark, sf_dir), TEST, chunk=TEST_CHUNK)


def _sink(spark, sf_dir):
    return schemas.project(_labelled(spark, sf_dir), schemas.BLOCK_LABEL_SCHEMA)


def _batches(panel) -> backfill.BatchPlan:
    bounds = quality.height_bounds(panel).first()
    return backfill.BatchPlan.of(
        bounds.min_height + TEST.vote_proposed_win_size - 1, bounds.max_height, TEST_BATCH_SIZE,
        TEST.vote_proposed_win_size, TEST.combine_win_size, TEST.label_win_size, bounds.min_height,
    )


def scan_panel(spark, sf_dir):
    return _stored_panel(spark, sf_dir)


def range_scan(spark, sf_dir):
    return files.range_scan(_stored_panel(spark, sf_dir), TEST.start_block, TEST.end_block)


def height_bounds(spark, sf_dir):
    return quality.height_bounds(weekly_panel(spark, sf_dir))


def block_stats(spark, sf_dir):
    return scoring.block_stats(weekly_panel(spark, sf_dir))


def voting_power_score(spark, sf_dir):
    return _powered(spark, sf_dir).select(*KEY, "tokens_proportion", "voting_power_score")


def commission_score(spark, sf_dir):
    return _commissioned(spark, sf_dir).select(*KEY, "commission_rate", "commission_score")


def self_bonded_score(spark, sf_dir):
    return _bonded(spark, sf_dir).select(*KEY, "self_bonded", "self_bonded_score")


def vote_points(spark, sf_dir):
    cleaned = scoring.clean(weekly_panel(spark, sf_dir))
    return scoring.vote_points(cleaned, TEST.vote_score, TEST.propose_score).select(*KEY, "vote_propose_point")


def moving_vote_sum(spark, sf_dir):
    points = written(vote_points(spark, sf_dir), "points")
    return scoring.moving_vote_sum(points, TEST.vote_proposed_win_size, chunk=TEST_CHUNK)


def stored_panel(spark, sf_dir):
    """The panel as its bucketed table gives it back."""
    return _laid_out(spark, sf_dir).rows()


def stored_moving_vote_sum(spark, sf_dir):
    """The activity over the bucketed panel, whose rows are not shuffled."""
    stored = _laid_out(spark, sf_dir)
    points = scoring.vote_points(scoring.clean(stored.placed()), TEST.vote_score, TEST.propose_score)
    narrow = points.select(*KEY, "vote_propose_point", Layout.CHUNK, Layout.HOME)
    return scoring.moving_vote_sum(narrow, TEST.vote_proposed_win_size, layout=stored.layout)


def stored_data_scoring(spark, sf_dir):
    """The whole run over the bucketed panel."""
    stored = _laid_out(spark, sf_dir)
    return scoring_plan.data_scoring(stored.placed(), TEST, chunk=TEST_CHUNK, layout=stored.layout)


def vote_proposed_score(spark, sf_dir):
    return _active(spark, sf_dir).select(*KEY, "vote_propose_score")


def validator_score_table(spark, sf_dir):
    return schemas.project(_scores(spark, sf_dir), schemas.VALIDATOR_SCORE_SCHEMA)


def top_validators(spark, sf_dir):
    return scoring_plan.survey(_panel(spark, sf_dir), TEST, chunk=TEST_CHUNK)


def validator_filter(spark, sf_dir):
    return _kept(spark, sf_dir).select(*KEY, "score")


def forward_label(spark, sf_dir):
    return labeling.shifting_data(_buckets(spark, sf_dir), TEST.label_win_size, TEST.combine_win_size)


def distinct_blocks(spark, sf_dir):
    return quality.distinct_blocks(minute_heights(spark, sf_dir))


def label_counts(spark, sf_dir):
    return quality.label_counts(_sink(spark, sf_dir))


def block_gaps(spark, sf_dir):
    return quality.block_gaps(minute_heights(spark, sf_dir))


def stride_histogram(spark, sf_dir):
    return quality.stride_histogram(_sink(spark, sf_dir))


def stride_gaps(spark, sf_dir):
    return quality.block_gaps(_sink(spark, sf_dir), TEST.combine_win_size)


def expected_buckets(spark, sf_dir):
    return quality.expected_buckets(
        weekly_panel(spark, sf_dir), TEST.vote_proposed_win_size, TEST.combine_win_size, TEST.label_win_size
    )


def key_violations(spark, sf_dir):
    """Lines of the same (order, supplier): the pairs that would not be a key."""
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return quality.key_violations(line, ("l_orderkey", "l_suppkey"))


def batch_intervals(spark, sf_dir):
    return _batches(weekly_panel(spark, sf_dir)).frame(spark)


def batch_coverage(spark, sf_dir):
    panel = weekly_panel(spark, sf_dir)
    return backfill.batch_coverage(_batches(panel), panel)


def batched_scoring(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    return backfill.batched_scoring(panel, _batches(panel), TEST, chunk=TEST_CHUNK)


def incremental_labels(spark, sf_dir):
    """The sink after all increments, which is that of one run over the whole history."""
    panel = _panel(spark, sf_dir)
    top = written(scoring_plan.survey(panel, TEST, chunk=TEST_CHUNK), "top")
    sink = spark.createDataFrame([], schemas.BLOCK_LABEL_SCHEMA)
    for end in TEST_INCREMENTS:
        new = backfill.incremental_labels(
            panel, sink, end, TEST, top, chunk=TEST_CHUNK, whole_buckets=end < TEST_INCREMENTS[-1]
        )
        sink = written(sink.unionByName(new), "sink")
    return sink


def carried_labels(spark, sf_dir):
    """The sink after all increments that carry their state and read the panel from one activity window before."""
    panel = _panel(spark, sf_dir)
    top = written(scoring_plan.survey(panel, TEST, chunk=TEST_CHUNK), "top")
    store = carried.Store(spark, staging_path(spark, "store"))
    for end in TEST_INCREMENTS:
        carried.advance(panel, store, end, TEST, top, last=end == TEST_INCREMENTS[-1], chunk=TEST_CHUNK)
    return store.labels()


def corrected_labels(spark, sf_dir):
    """The sink after increments over wrong rows, the correction of those rows, and a last increment."""
    panel = _panel(spark, sf_dir)
    damaged = written(damaged_panel(panel), "damaged")
    top = written(scoring_plan.survey(panel, TEST, chunk=TEST_CHUNK), "top")
    store = carried.Store(spark, staging_path(spark, "store"))
    for end in TEST_INCREMENTS[:-1]:
        carried.advance(damaged, store, end, TEST, top, chunk=TEST_CHUNK)
    changes = written(corrections.changed_rows(damaged, panel), "changes")
    corrections.correct(panel, store, changes, TEST, chunk=TEST_CHUNK)
    carried.advance(panel, store, TEST_INCREMENTS[-1], TEST, last=True, chunk=TEST_CHUNK)
    return store.labels()


def arriving_labels(spark, sf_dir):
    """The sink after three arrivals of files, the last with rows that come late, each taken by a run of its own."""
    source, path = staging_path(spark, "arriving"), staging_path(spark, "store")
    panel = written(schemas.project(weekly_panel(spark, sf_dir), schemas.PANEL_SCHEMA), "panel")
    first, second, third, _ = TEST_INCREMENTS
    late = F.col(HEIGHT).between(third - 20, third - 18)
    for part in ((F.col(HEIGHT) <= first), (F.col(HEIGHT) > first) & (F.col(HEIGHT) <= third) & ~late, late | (F.col(HEIGHT) > third)):
        panel.filter(part).write.mode("append").parquet(source)
        arrivals = Arrivals(spark, source, path, TEST, chunk=TEST_CHUNK)
        arrivals.run()
    arrivals.finish()
    return arrivals.labels()


def dropped_rows(spark, sf_dir):
    """How many rows of the top validators the whole run drops, by cause."""
    _, account = accounting.accounted_scoring(_panel(spark, sf_dir), TEST, chunk=TEST_CHUNK)
    return accounting.frame(spark, account)


def sketched_counts(spark, sf_dir):
    """Counts of the minutes of all events from sketches of four increments, one of them noted twice: the exact numbers, and whether the
    sketches' lie within three times their error.
    """
    heights = minute_heights(spark, sf_dir)
    sketches = Sketches(spark, staging_path(spark, "sketches"), [HEIGHT], [HEIGHT])
    for part in (2, 0, 3, 1, 3):
        sketches.add(heights.filter(F.pmod(F.floor(F.col(HEIGHT) / 1000), F.lit(4)) == part), part)
    noted = sketches.counts()
    exact = heights.withColumn("_median", sketches.quantiles(HEIGHT, [0.5]).select("value").scalar()).agg(
        F.count(HEIGHT).alias("rows"), F.countDistinct(HEIGHT).alias("heights"),
        F.count_if(F.col(HEIGHT) < F.col("_median")).alias("_below"), F.count_if(F.col(HEIGHT) <= F.col("_median")).alias("_upto"),
    ).withColumns({"_noted": noted.select("rows").scalar(), "_estimate": noted.select(HEIGHT).scalar()})
    middle, slack = F.col("rows") / 2, 3 * sketches.rank_error() * F.col("rows")
    within = {
        "rows": ("rows", F.col("_noted") == F.col("rows")),
        "heights": ("heights", F.abs(F.col("_estimate") - F.col("heights")) <= 3 * sketches.distinct_error() * F.col("heights")),
        "median": ("rows", (F.col("_below") <= middle + slack) & (F.col("_upto") >= middle - slack)),
    }
    return exact.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("name"), F.col(number).alias("exact"), holds.alias("within")) for name, (number, holds) in within.items()
    ])))


def _kept_runs(spark, heights, stride=1) -> runs.HeightRuns:
    """The runs of ``heights`` after increments in falling order that overlap, the first of them twice."""
    kept = runs.HeightRuns(spark, staging_path(spark, "runs"), stride, chunk=TEST_RUN_CHUNK)
    third = F.pmod(F.floor(F.col(HEIGHT) / 100), F.lit(3))
    for part in (third >= 1, third >= 1, third <= 1):
        kept.add(heights.filter(part))
    return kept


def kept_gaps(spark, sf_dir):
    return runs.block_gaps(_kept_runs(spark, minute_heights(spark, sf_dir)).runs())


def kept_heights(spark, sf_dir):
    """Bounds and number of heights, after a part of them was withdrawn, counted again, and given back."""
    heights = minute_heights(spark, sf_dir)
    kept = _kept_runs(spark, heights)
    kept.recount(heights.filter(F.col(HEIGHT) % 2 == 0), 5_000, 9_000)
    kept.recount(heights, 5_000, 9_000)
    kept.compact()
    return runs.summary(kept.runs())


def kept_stride_gaps(spark, sf_dir):
    sink = written(_sink(spark, sf_dir).select(HEIGHT), "sink")
    return runs.block_gaps(_kept_runs(spark, sink, TEST.combine_win_size).runs(), TEST.combine_win_size)


def kept_stride_histogram(spark, sf_dir):
    sink = written(_sink(spark, sf_dir).select(HEIGHT), "sink")
    return runs.stride_histogram(_kept_runs(spark, sink, TEST.combine_win_size).runs(), TEST.combine_win_size)


def covers(spark, sf_dir):
    return backfill.covers(weekly_panel(spark, sf_dir), TEST.end_block)


def resume_point(spark, sf_dir):
    return backfill.resume_point(
        _sink(spark, sf_dir), weekly_panel(spark, sf_dir), TEST.start_block, TEST.combine_win_size
    )


def append_dedup(spark, sf_dir):
    """The labels of the whole history, after a run over the history up to the survey's end."""
    panel = _panel(spark, sf_dir)
    history = files.range_scan(panel, 0, TEST.end_block)
    sink = scoring_plan.data_scoring(history, TEST, chunk=TEST_CHUNK)
    labelled = scoring_plan.data_scoring(panel, TEST, chunk=TEST_CHUNK)
    return backfill.append_dedup(labelled, sink).select(*KEY, "score", "label")


def csv_roundtrip(spark, sf_dir):
    path = staging_path(spark, "heights")
    files.write_heights(minute_heights(spark, sf_dir), path)
    return files.read_heights(spark, path)


QUERIES: dict[str, Query] = {
    "scan_panel": scan_panel,
    "range_scan": range_scan,
    "height_bounds": height_bounds,
    "preprocess": _preprocessed,
    "block_stats": block_stats,
    "voting_power_score": voting_power_score,
    "commission_score": commission_score,
    "self_bonded_score": self_bonded_score,
    "vote_points": vote_points,
    "moving_vote_sum": moving_vote_sum,
    "stored_panel": stored_panel,
    "stored_moving_vote_sum": stored_moving_vote_sum,
    "stored_data_scoring": stored_data_scoring,
    "vote_proposed_score": vote_proposed_score,
    "final_score": _scored,
    "validator_score_table": validator_score_table,
    "top_validators": top_validators,
    "validator_filter": validator_filter,
    "combine_data": _buckets,
    "forward_label": forward_label,
    "data_scoring": _labelled,
    "sink_projection": _sink,
    "distinct_blocks": distinct_blocks,
    "label_counts": label_counts,
    "block_gaps": block_gaps,
    "stride_histogram": stride_histogram,
    "stride_gaps": stride_gaps,
    "expected_buckets": expected_buckets,
    "key_violations": key_violations,
    "batch_intervals": batch_intervals,
    "batch_coverage": batch_coverage,
    "batched_scoring": batched_scoring,
    "incremental_labels": incremental_labels,
    "carried_labels": carried_labels,
    "corrected_labels": corrected_labels,
    "arriving_labels": arriving_labels,
    "dropped_rows": dropped_rows,
    "sketched_counts": sketched_counts,
    "kept_gaps": kept_gaps,
    "kept_heights": kept_heights,
    "kept_stride_gaps": kept_stride_gaps,
    "kept_stride_histogram": kept_stride_histogram,
    "covers": covers,
    "resume_point": resume_point,
    "append_dedup": append_dedup,
    "csv_roundtrip": csv_roundtrip,
}


def registered() -> dict[str, Query]:
    def wrap(query: Query) -> Query:
        def run(spark, sf_dir):
            give_folder(spark)
            return comparable(query(spark, sf_dir))

        return run

    return {name: wrap(query) for name, query in QUERIES.items()}
