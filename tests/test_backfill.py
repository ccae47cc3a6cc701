"""Batch plans, batched scoring, resume and append."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from stakescore.catalog.panels import TEST, weekly_panel
from stakescore.params import LOCAL, LOCAL_BATCH_SIZE, PRODUCTION, PRODUCTION_BATCH_SIZE, ScoringParams
from stakescore.plans.data_scoring import data_scoring, survey
from stakescore.schemas import BLOCK_LABEL_SCHEMA, project
from stakescore.staging import written
from stakescore.incremental import backfill
from stakescore.incremental.backfill import BatchPlan
from tests.conftest import rows_of

SMALL = ScoringParams(
    accept_rate=0.1, concentration_level=0.9, vote_score=2, propose_score=6, A=9, B=4, C=2, D=4,
    vote_proposed_win_size=8, combine_win_size=4, label_win_size=12,
)


def plan(start, end, size, params, low, **kwargs):
    return BatchPlan.of(
        start, end, size, params.vote_proposed_win_size, params.combine_win_size, params.label_win_size, low, **kwargs
    )


def intervals(spark, batches):
    return [tuple(r)[1:] for r in batches.frame(spark).orderBy("batch_id").collect()]


def test_local_intervals(spark):
    batches = plan(7_100_000, 7_103_999, LOCAL_BATCH_SIZE, LOCAL, 7_049_472)
    assert intervals(spark, batches) == [
        (7_099_501, 7_101_499), (7_100_941, 7_102_939), (7_102_381, 7_103_999),
    ]
    panel = spark.range(7_099_501, 7_104_000).selectExpr("cast(id AS int) AS block_height")
    covered = backfill.batch_coverage(batches, panel).orderBy("batch_id")
    assert [r["buckets"] for r in covered.collect()] == [72, 72, 53]
    assert [r["present_buckets"] for r in covered.collect()] == [72, 72, 53]
    ends = covered.agg(F.min("first_label"), F.max("last_label")).first()
    assert tuple(ends) == (7_100_000, 7_103_920)


def test_production_intervals(spark):
    batches = plan(7_063_871, 7_303_870, PRODUCTION_BATCH_SIZE, PRODUCTION, 7_049_472)
    assert intervals(spark, batches) == [
        (7_049_472, 7_199_470), (7_084_272, 7_234_270), (7_119_072, 7_269_070), (7_153_872, 7_303_870),
    ]
    heights = spark.range(7_049_472, 7_303_871).selectExpr("cast(id AS int) AS block_height")
    assert [r["buckets"] for r in backfill.batch_coverage(batches, heights).collect()] == [232] * 4


def test_first_batch_is_clamped_to_the_first_block(spark):
    assert intervals(spark, plan(3, 100, 87, SMALL, 1))[0] == (1, 87)


@pytest.mark.parametrize("end", range(60, 330, 9))
def test_labelled_starts_run_without_a_gap(spark, end):
    batches = plan(20, end, 87, SMALL, 0)
    v, c, ahead = 8, 4, 12
    labelled, last = [], None
    for start, stop in intervals(spark, batches):
        assert stop <= end and stop - start + 1 <= 87
        labelled += range(start + v - 1, stop - ahead - c + 2, c)
        last = stop
    if last is not None:
        assert labelled == list(range(20, labelled[-1] + 1, c))
        # One more bucket would need heights beyond the end.
        assert labelled[-1] + c + ahead + c - 1 > end
    else:
        assert 20 + c + ahead - 1 > end


def test_tail_with_one_labelled_bucket(spark):
    # The first batch ends at 99, so the second starts at 81 and its warm rows at 88.
    end = 81 + 8 + 4 + 12 - 1 - 1
    assert len(intervals(spark, plan(20, end, 87, SMALL, 0))) == 2
    assert len(intervals(spark, plan(20, end, 87, SMALL, 0, strict=True))) == 1
    assert len(intervals(spark, plan(20, end + 4, 87, SMALL, 0, strict=True))) == 2


def test_no_batches(spark, panel_of):
    batches = plan(20, 10, 87, SMALL, 0)
    assert intervals(spark, batches) == []
    panel = panel_of([{"block_height": 1, "operator_address": "a"}])
    assert batches.assign(panel).count() == 0


@pytest.mark.parametrize("size, params", [(23, SMALL), (88, SMALL)])
def test_window_conditions(size, params):
    with pytest.raises(ValueError):
        plan(0, 100, size, params, 0)
    with pytest.raises(ValueError):
        BatchPlan.of(0, 100, 87, 8, 4, 10, 0)


def test_rows_go_to_every_batch_that_holds_them(spark):
    batches = plan(20, 250, 87, SMALL, 0)
    spans = intervals(spark, batches)
    panel = spark.range(0, 300).selectExpr("cast(id AS int) AS block_height")
    got = rows_of(batches.assign(panel), "batch_id", "block_height")
    assert got == sorted(((i, h) for i, (a, b) in enumerate(spans) for h in range(a, b + 1)), key=repr)


@pytest.fixture(scope="module")
def dense(spark):
    """5 validators at each of 399 heights, which make whole buckets."""
    h, v = F.col("h"), F.col("v")
    return spark.range(5 * 399).selectExpr("id div 5 AS h", "id % 5 AS v").select(
        h.cast("int").alias("block_height"),
        F.concat(F.lit("val"), v).alias("operator_address"),
        (1000 + v * 300 + h % 17).cast("decimal(38,0)").alias("tokens"),
        (2000 + v).cast("decimal(38,0)").alias("delegator_shares"),
        (v * 100 + h % 5).cast("decimal(38,0)").alias("self_bonded"),
        (v * 2e16).cast("float").alias("commission_rate"),
        ((h * 7 + v) % 50 == 0).alias("jailed"),
        ((h + v) % 3 > 0).alias("vote"),
        ((h * v) % 11 == 1).alias("propose"),
        F.lit("BOND_STATUS_BONDED").alias("status"),
    )


def comparable(df):
    return rows_of(df.select(
        "operator_address", "block_height", "tokens", *[F.col(c).cast("float").alias(c) for c in ("score", "label")]
    ))


@pytest.mark.parametrize("top", [None, 3])
def test_batches_equal_the_whole_history_on_a_dense_panel(spark, dense, top):
    params = SMALL if top is None else replace(SMALL, start_block=30, end_block=60, top_validators=top)
    whole = data_scoring(dense, params, chunk=50)
    batched = backfill.batched_scoring(dense, plan(7, 398, 87, SMALL, 0), params)
    assert comparable(batched) == comparable(whole)
    assert whole.count() == (top or 5) * 95


def test_resume_continues_where_one_run_would(spark, dense):
    whole = project(data_scoring(dense, SMALL), BLOCK_LABEL_SCHEMA)
    first = plan(7, 200, 87, SMALL, 0)
    sink = project(backfill.batched_scoring(dense.filter("block_height <= 200"), first, SMALL), BLOCK_LABEL_SCHEMA)
    point = backfill.resume_point(sink, dense, 7, SMALL.combine_win_size).first()
    assert point["global_end"] == 398
    second = plan(point["resume_start"], point["global_end"], 87, SMALL, 0)
    later = project(backfill.batched_scoring(dense, second, SMALL), BLOCK_LABEL_SCHEMA)
    assert later.select("block_height").join(sink.select("block_height"), "block_height").count() == 0
    assert comparable(sink.unionByName(later)) == comparable(whole)


def test_increments_add_up_to_the_whole_history(spark, dense):
    sink = spark.createDataFrame([], BLOCK_LABEL_SCHEMA)
    for end in (150, 290, 398, 398):
        new = backfill.incremental_labels(dense, sink, end, SMALL, chunk=50, whole_buckets=end < 398)
        sink = written(sink.unionByName(new), "sink")
    assert comparable(sink) == comparable(data_scoring(dense, SMALL))
    with pytest.raises(ValueError):
        backfill.incremental_labels(dense, sink, 399, SMALL)


@pytest.mark.parametrize("top", [None, 8])
def test_increments_on_a_panel_with_gaps(spark, sf_dir, top):
    panel = written(weekly_panel(spark, sf_dir), "panel")
    params = replace(TEST, top_validators=top)
    names = None if top is None else written(survey(panel, params), "top")
    sink = spark.createDataFrame([], BLOCK_LABEL_SCHEMA)
    for end in (200, 260, 350, 351, 430, 513):
        new = backfill.incremental_labels(panel, sink, end, params, names, chunk=32, whole_buckets=end < 513)
        sink = written(sink.unionByName(new), "sink")
    whole = project(data_scoring(panel, params), BLOCK_LABEL_SCHEMA)
    assert whole.count() == (678 if top is None else 545)
    assert comparable(sink) == comparable(whole)


def test_an_increment_can_be_repeated(spark, sf_dir, tmp_path):
    panel = written(weekly_panel(spark, sf_dir), "panel")
    params = replace(TEST, top_validators=None)
    path = str(tmp_path / "sink")
    for end in (300, 300, 513, 513):
        backfill.append_labels(panel, path, end, params, whole_buckets=end < 513)
    sink = spark.read.parquet(path)
    assert comparable(sink) == comparable(project(data_scoring(panel, params), BLOCK_LABEL_SCHEMA))


def test_the_sink_is_read_from_the_first_start_on(spark, sf_dir):
    panel = written(weekly_panel(spark, sf_dir), "panel")
    params = replace(TEST, top_validators=None)
    sink = written(project(data_scoring(panel.filter("block_height <= 400"), params), BLOCK_LABEL_SCHEMA), "sink")
    plan_text = backfill.incremental_labels(panel, sink, 513, params)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(block_height,3" in plan_text


def test_assigned_heights_are_pushed_to_the_scan(spark, dense):
    plan_text = plan(20, 250, 87, SMALL, 0).assign(written(dense, "dense"))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(block_height,13)" in plan_text and "LessThanOrEqual(block_height," in plan_text


def test_resume_of_an_empty_sink(spark, dense):
    empty = spark.createDataFrame([], BLOCK_LABEL_SCHEMA)
    assert tuple(backfill.resume_point(empty, dense, 7, 4).first()) == (7, 398)


def test_append_dedup_is_idempotent(spark):
    new = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0)], "block_height int, operator_address string, score double")
    sink = new.filter("block_height = 1")
    assert rows_of(backfill.append_dedup(new, sink), "block_height") == [(2,)]
    assert backfill.append_dedup(new, new).count() == 0


def test_covers(spark, dense):
    assert tuple(backfill.covers(dense, 398).first()) == (398, True)
    assert tuple(backfill.covers(dense, 399).first()) == (398, False)
