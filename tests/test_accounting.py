"""The account of dropped rows against counts made apart from the run."""

import pytest
from pyspark.sql import functions as F

from stakescore.catalog.panels import TEST, TEST_CHUNK, weekly_panel
from stakescore.plans import accounting, data_scoring as plans
from stakescore.staging import written
from tests.conftest import TESTDATA, rows_of


@pytest.fixture(scope="module")
def panel(spark):
    """Some rows lack an amount, some a flag; nobody has tokens in one block."""
    height = F.col("block_height")
    holes = {
        "tokens": F.when(height % 97 != 3, F.when(height == 320, 0).otherwise(F.col("tokens"))).cast("decimal(38,0)"),
        "self_bonded": F.when(height % 89 != 3, F.col("self_bonded")).cast("decimal(38,0)"),
        "commission_rate": F.when(height % 83 != 5, F.col("commission_rate")).otherwise(F.lit(float("nan"))),
    }
    return written(weekly_panel(spark, f"{TESTDATA}/sf0.001").withColumns(holes), "panel")


@pytest.mark.parametrize("keep", ["all", "survey", "three"])
def test_the_account_adds_up(spark, panel, keep):
    params = TEST if keep == "survey" else type(TEST)(**{**TEST.__dict__, "top_validators": None})
    names = [r[0] for r in panel.select("operator_address").distinct().orderBy("operator_address").limit(3).collect()]
    top = spark.createDataFrame([(n,) for n in names], "operator_address string") if keep == "three" else None
    if keep == "survey":
        top = written(plans.survey(panel, params, chunk=TEST_CHUNK), "top")
    labels, account = accounting.accounted_scoring(panel, params, top, chunk=TEST_CHUNK)
    expected = plans.data_scoring(panel, params, top=top, chunk=TEST_CHUNK)
    assert rows_of(labels.select("block_height", "operator_address")) == rows_of(expected.select("block_height", "operator_address"))

    own = panel if top is None else panel.join(top, "operator_address", "left_semi")
    assert account["rows"] == own.count() == sum(account[c] for c in accounting.causes())
    assert account["null_tokens"] == own.filter("tokens is null").count() > 0
    assert account["null_self_bonded"] == own.filter("tokens is not null and self_bonded is null").count() > 0
    assert account["null_commission_rate"] == own.filter(
        "tokens is not null and self_bonded is not null and isnan(commission_rate)").count() > 0
    assert account["dead_block"] >= own.filter(
        "block_height = 320 and tokens = 0 and self_bonded is not null and jailed is not null and not isnan(commission_rate)").count() > 0
    assert account["labelled"] <= labels.count() * TEST.combine_win_size and account["no_horizon"] > 0


def test_the_panel_is_not_read_more_often(spark, panel, monkeypatch):
    """As many scans of the panel as the run has without an account."""
    folder = panel.inputFiles()[0].rsplit("/", 2)[1]
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    scans = {"plain": 0, "counted": 0}

    def counting(kind):
        def stage(df, name):
            plan = df._jdf.queryExecution().executedPlan().toString()
            scans[kind] += sum("FileScan" in line and folder in line for line in plan.splitlines())
            return written(df, name)

        return stage

    try:
        plain = counting("plain")
        plain(plans.data_scoring(panel, TEST, stage=plain, chunk=TEST_CHUNK), "labels")
        counted = counting("counted")
        monkeypatch.setattr(accounting, "written", counted)
        accounting.accounted_scoring(panel, TEST, chunk=TEST_CHUNK)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert 0 < scans["counted"] <= scans["plain"]


def test_an_empty_panel(spark, panel):
    params = type(TEST)(**{**TEST.__dict__, "top_validators": None})
    labels, account = accounting.accounted_scoring(written(panel.limit(0), "empty"), params, chunk=TEST_CHUNK)
    assert labels.count() == 0 and set(account.values()) == {0}
    assert accounting.frame(spark, account).count() == 1 + len(accounting.causes())
