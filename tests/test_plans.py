"""Shapes of the physical plans."""

from dataclasses import replace

import pytest

from stakescore.catalog.panels import TEST, weekly_panel
from stakescore.catalog.queries import QUERIES
from stakescore.operators import labeling, scoring
from stakescore.plans import data_scoring as plans
from stakescore.staging import lazy, written
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def panel(spark, sf_dir):
    return written(weekly_panel(spark, sf_dir), "panel")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def jobs(spark, build):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        build()
        return len(tracker.getJobIdsForGroup("building"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_activity_reads_all_columns_once(panel):
    plan = plan_of(plans.activity_rows(panel, TEST))
    narrow = "ReadSchema: struct<block_height:int,operator_address:string,vote:boolean,propose:boolean>"
    assert (plan.count("FileScan"), plan.count(narrow)) == (3, 2)


def test_the_largest_activity_needs_no_amounts(panel):
    rows = plans.activity_rows(panel, TEST, ()).filter(plans.eligible(TEST))
    plan = plan_of(plans.largest_activity(rows))
    exchanged = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanged
    # The amounts are read for the flag that tells complete rows, and end at the scan's projection.
    assert not any("Window" in line and "delegator_shares" in line for line in plan.splitlines())
    assert not any("Sort" in line and "tokens" in line for line in plan.splitlines())


def staged(monkeypatch):
    """What is staged, by name, while it is."""
    seen = {}

    def stage(df, name):
        seen[name] = written(df, name)
        return seen[name]

    return seen, stage


def test_only_kept_validators_are_staged_at_full_width(monkeypatch, panel):
    seen, stage = staged(monkeypatch)
    plans.data_scoring(panel, replace(TEST, top_validators=3), stage=stage).count()
    assert set(seen) == {"survey", "survey-blocks", "top", "blocks", "scored"}
    for name, df in seen.items():
        assert ("delegator_shares" in df.columns) == (name == "scored")
    assert seen["scored"].select("operator_address").distinct().count() == 3


def test_rows_meet_block_values_once(monkeypatch, panel):
    seen, stage = staged(monkeypatch)
    plan = plan_of(plans.data_scoring(panel, replace(TEST, top_validators=3), stage=stage))
    assert "total_token_amt_per_block" not in plan and plan.count("parquet") >= 1
    assert all("scored" in path for path in plans.data_scoring(panel, replace(TEST, top_validators=3), stage=stage).inputFiles())


def test_block_totals_are_one_aggregation(panel):
    plan = plan_of(plans.total_values(panel))
    assert (plan.count("FileScan"), plan.count("Exchange"), plan.count("Join")) == (1, 1, 0)
    assert "delegator_shares" not in plan


def test_survey_reads_its_window_and_counts_the_rest(panel):
    plan = plan_of(plans.survey(panel, replace(TEST, top_validators=5), stage=lazy))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    first = TEST.start_block - TEST.vote_proposed_win_size + 1
    for line in scans:
        window = f"GreaterThanOrEqual(block_height,{first})" in line or "GreaterThanOrEqual(block_height,180)" in line
        assert window or ("ReadSchema: struct<block_height:int,operator_address:string>" in line
                          and f"LessThan(block_height,{first})" in line)


def test_rows_go_to_batches_after_the_activity_window(panel):
    from stakescore.catalog.queries import _batches
    from stakescore.incremental import backfill

    frames = {}

    def note(df, name):
        frames[name] = df
        return written(df, name)

    backfill.batched_scoring(panel, _batches(panel), replace(TEST, top_validators=3), stage=note)
    for name in ("scored", "blocks"):
        plan = frames[name]._jdf.queryExecution().optimizedPlan().toString().splitlines()
        depth = {i: len(line) - len(line.lstrip(" :+-")) for i, line in enumerate(plan)}
        windows = [i for i, line in enumerate(plan) if "Window [" in line and "_delta" in line]
        assert windows
        for i in windows:  # what stands below a window is deeper, until a line that is not
            below = [line for j, line in enumerate(plan) if j > i and all(depth[k] > depth[i] for k in range(i + 1, j + 1))]
            assert below and not any("batch_id" in line for line in below)


def test_lazy_build_starts_no_job(spark, panel):
    assert jobs(spark, lambda: plans.data_scoring(panel, replace(TEST, top_validators=5), stage=lazy)) == 0


@pytest.mark.parametrize("name", ["data_scoring", "batched_scoring", "block_gaps", "final_score"])
def test_no_python_and_no_nested_loops(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert word not in plan


def test_step_operators_build_without_a_job(spark, panel):
    def build():
        frame = scoring.preprocess(panel)
        frame = scoring.commission_score(scoring.voting_power_score(frame), TEST.accept_rate)
        frame = scoring.self_bonded_score(frame, TEST.concentration_level)
        frame = scoring.vote_proposed_score(frame, 2, 6, 8)
        labeling.validator_filter(scoring.final_score(frame, 9, 4, 2, 4), 180, 300, 3)

    assert jobs(spark, build) == 0


@pytest.mark.parametrize("run", [
    lambda df: plans.data_scoring(df, replace(TEST, top_validators=None)),
    lambda df: plans.score_panel(df, TEST),
    lambda df: labeling.combine_data(df.selectExpr(
        "operator_address", "block_height", *[f"cast(1 AS double) AS {c}" for c in labeling.BUCKET_MEANS]), 4),
])
def test_one_copied_row_fails_the_run(panel, run):
    copied = written(panel.unionByName(panel.limit(1)), "copied")
    with pytest.raises(Exception, match="block and validator are not a key"):
        run(copied).collect()


@pytest.mark.parametrize("chunk", [15, 16, 64, 16_384])
def test_activity_by_copies_ahead_is_the_same(panel, chunk):
    once = plans.activity_once(panel, TEST, chunk=chunk)
    rows = plans.activity_rows(panel, TEST, chunk=chunk)
    assert once.columns == rows.columns and rows_of(once) == rows_of(rows)
    assert plan_of(once).count("FileScan") == (3 if chunk < 16 else 2)
