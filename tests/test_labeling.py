"""Survey, buckets and labels on small frames."""

import pytest

from stakescore.operators import labeling
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def survey_rows(spark):
    """Four validators at heights 11 to 14. Over them red has mean 6, blue 5 (without height 13), gold and
    teal 3 each, so that a cut after the third place falls between equal means.
    """
    rows = [
        ("red", 11, 9.0), ("red", 12, 3.0), ("red", 13, 6.0), ("red", 14, 6.0),
        ("blue", 11, 4.0), ("blue", 12, 5.0), ("blue", 14, 6.0),
        ("teal", 11, 3.0), ("teal", 12, 3.0), ("teal", 13, 3.0), ("teal", 14, 3.0),
        ("gold", 11, 0.0), ("gold", 12, 6.0), ("gold", 13, 2.0), ("gold", 14, 4.0),
    ]
    return spark.createDataFrame(rows, "operator_address string, block_height int, score double")


def names(df):
    return {r[0] for r in df.select("operator_address").distinct().collect()}


def test_ties_at_the_cut_go_to_the_smaller_address(survey_rows):
    top = labeling.survey_top(survey_rows, 11, 14, 3)
    assert rows_of(top, "operator_address", "mean_score") == [("blue", 5.0), ("gold", 3.0), ("red", 6.0)]
    kept = labeling.validator_filter(survey_rows, 11, 14, 3)
    assert names(kept) == {"red", "blue", "gold"}
    assert kept.count() == 11


def test_the_survey_window_is_inclusive_and_history_is_kept_whole(survey_rows):
    # Over 12 and 13: gold (6 + 2) / 2, red (3 + 6) / 2, blue 5 / 1, teal 3.
    kept = labeling.validator_filter(survey_rows, 12, 13, 2)
    assert names(kept) == {"blue", "red"}
    assert kept.count() == 7


def test_empty_survey_keeps_nothing(survey_rows):
    assert labeling.validator_filter(survey_rows, 50, 60, 3).count() == 0


def test_null_means_rank_last(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", 1, -5.0)], "operator_address string, block_height int, score double")
    assert names(labeling.validator_filter(df, 1, 1, 1)) == {"b"}
    assert names(labeling.validator_filter(df, 1, 1, 2)) == {"a", "b"}


def scored(spark, rows):
    columns = [c for c in labeling.BUCKET_MEANS if c != "score"]
    df = spark.createDataFrame(rows, "operator_address string, block_height int, score double")
    return df.selectExpr("*", *[f"cast(block_height AS double) AS {c}" for c in columns])


def test_buckets_count_rows_and_keep_a_short_tail(spark):
    df = scored(spark, [("a", h, float(h)) for h in (1, 2, 5, 9, 10)] + [("b", 7, 1.0)])
    got = labeling.combine_data(df, 2, chunk=3)
    assert rows_of(got, "operator_address", "new_block", "block_height", "score", "tokens") == [
        ("a", 0, 1, 1.5, 1.5), ("a", 1, 5, 7.0, 7.0), ("a", 2, 10, 10.0, 10.0), ("b", 0, 7, 1.0, 7.0),
    ]


def test_label_includes_the_current_bucket_and_needs_the_far_end(spark):
    df = scored(spark, [("a", h, float(h)) for h in range(1, 6)] + [("b", 1, 1.0), ("b", 2, 1.0)])
    labelled = labeling.shifting_data(labeling.combine_data(df, 1), 2, 1)
    assert rows_of(labelled, "operator_address", "new_block", "label") == [("a", 0, 2.0), ("a", 1, 3.0), ("a", 2, 4.0)]


def test_null_scores_are_left_out_of_labels(spark):
    df = scored(spark, [("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0), ("a", 4, None), ("a", 5, 5.0)])
    labelled = labeling.shifting_data(labeling.combine_data(df, 1), 2, 1)
    assert rows_of(labelled, "new_block", "label") == [(0, 2.0), (2, 4.0)]


def test_label_window_must_be_whole_buckets(spark):
    with pytest.raises(ValueError):
        labeling.shifting_data(scored(spark, [("a", 1, 1.0)]), 5, 2)


def test_bucket_means_are_those_of_the_label_table():
    assert set(labeling.BUCKET_MEANS) == {
        "tokens", "commission_rate", "delegator_shares", "self_bonded", "tokens_proportion",
        "voting_power_score", "commission_score", "self_bonded_score", "vote_propose_score", "score",
    }
