"""Increments with carried state, their repetition, and corrections, each against one run over the whole history."""

import re

import pytest
from pyspark.sql import functions as F

from stakescore import schemas
from stakescore.catalog.panels import TEST, TEST_CHUNK, TEST_INCREMENTS, weekly_panel
from stakescore.incremental import carried, corrections
from stakescore.plans import data_scoring as plans
from stakescore.staging import staging_path, written
from tests.conftest import TESTDATA

ENDS = TEST_INCREMENTS


def rows(df):
    """Sorted rows; sums of doubles may differ in the last bits."""
    columns = sorted(df.columns)
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(columns).collect()), key=repr)


@pytest.fixture(scope="module")
def panel(spark):
    return written(weekly_panel(spark, f"{TESTDATA}/sf0.001"), "panel")


@pytest.fixture(scope="module")
def top(spark, panel):
    return written(plans.survey(panel, TEST, chunk=TEST_CHUNK), "top")


@pytest.fixture(scope="module")
def expected(panel, top):
    return rows(schemas.project(plans.data_scoring(panel, TEST, top=top, chunk=TEST_CHUNK), schemas.BLOCK_LABEL_SCHEMA))


def run(spark, panel, top, ends=ENDS, last=True):
    store = carried.Store(spark, staging_path(spark, "store"))
    for end in ends:
        carried.advance(panel, store, end, TEST, top, last=last and end == ENDS[-1], chunk=TEST_CHUNK)
    return store


def tables(store):
    return {n: rows(store.table(n).drop("increment")) for n in ("labels", "buckets", "blocks")} | {
        n: rows(store.state()[n]) for n in ("open", "pending", "top")}


@pytest.fixture(scope="module")
def three(spark, panel, top):
    """The tables after three increments over the right panel."""
    return tables(run(spark, panel, top, ENDS[:3], last=False))


@pytest.mark.parametrize("ends", [(200, 201, 300, 513), (513,)])
def test_increments_give_the_labels_of_one_run(spark, panel, top, expected, ends):
    store = run(spark, panel, top, ends)
    assert rows(store.labels()) == expected and store.ends() == list(ends)


def test_every_scan_of_an_increment_begins_one_window_before(spark, panel, top, monkeypatch):
    store = run(spark, panel, top, ENDS[:2], last=False)
    scans, folder = [], panel.inputFiles()[0].rsplit("/", 2)[1]
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")

    def seen(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans.extend(line for line in plan.splitlines() if "FileScan" in line and folder in line)
        return df

    keep, keep_state = store.keep, store.keep_state
    monkeypatch.setattr(store, "keep", lambda name, end, df: keep(name, end, seen(df)))
    monkeypatch.setattr(store, "keep_state", lambda frames, end: keep_state({n: seen(f) for n, f in frames.items()}, end))
    try:
        carried.advance(panel, store, ENDS[2], TEST, stage=lambda df, name: written(seen(df), name), chunk=TEST_CHUNK)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(scans) >= 4
    low = ENDS[1] - TEST.vote_proposed_win_size + 2
    for scan in scans:
        assert re.search(rf"PushedFilters: \[[^\]]*GreaterThanOrEqual\(block_height,{low}\)", scan), scan


def test_older_heights_are_not_needed(spark, panel, top, expected):
    """Rows below the window may be gone from the source."""
    store = run(spark, panel, top, ENDS[:3], last=False)
    rest = written(panel.filter(F.col("block_height") > ENDS[2] - TEST.vote_proposed_win_size + 1), "rest")
    carried.advance(rest, store, ENDS[3], TEST, last=True, chunk=TEST_CHUNK)
    assert rows(store.labels()) == expected


@pytest.mark.parametrize("at", ["labels", "commit"])
def test_a_killed_increment_is_repeated(spark, panel, top, expected, monkeypatch, at):
    store = run(spark, panel, top, ENDS[:2], last=False)
    before = rows(store.labels())

    def killed(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        if at == "commit":
            patch.setattr(carried.Store, "commit", killed)
        else:
            keep = carried.Store.keep
            patch.setattr(carried.Store, "keep", lambda self, name, end, df: killed() if name == at and keep(self, name, end, df) else keep(self, name, end, df))
        with pytest.raises(RuntimeError, match="killed"):
            carried.advance(panel, store, ENDS[2], TEST, chunk=TEST_CHUNK)
    assert rows(store.labels()) == before  # what it wrote does not show
    for end in (ENDS[2], ENDS[3], ENDS[3], ENDS[1]):  # repetitions of finished ones do nothing
        carried.advance(panel, store, end, TEST, last=end == ENDS[3], chunk=TEST_CHUNK)
    assert rows(store.labels()) == expected


def damage(spark, panel, kinds):
    for kind in kinds.split():
        panel = written(damaged(spark, panel, kind).select(panel.columns), "damaged")
    return panel


def damaged(spark, panel, kind):
    key = ["block_height", "operator_address"]
    at = panel.filter("block_height between 300 and 303").select(key).orderBy(key)
    if kind == "late":
        return panel.join(F.broadcast(at.limit(3)), key, "left_anti")
    if kind == "early":
        return panel.join(F.broadcast(panel.filter("block_height between 158 and 162").select(key).orderBy(key).limit(4)), key, "left_anti")
    if kind == "extra":
        return panel.unionByName(panel.filter("block_height = 250").limit(2).withColumn("operator_address", F.concat(F.lit("new"), "operator_address")))
    if kind == "dead":  # its rows have no scores until it is right
        return panel.withColumn("tokens", F.when(F.col("block_height") != 310, F.col("tokens")).otherwise(0).cast("decimal(38,0)"))
    if kind == "null":
        return panel.withColumn("status", F.when(F.col("block_height") != 320, F.col("status")))
    if kind == "open":
        return panel.withColumn("vote", F.when(F.col("block_height") < 429, F.col("vote")).otherwise(False))
    return panel.withColumn("self_bonded", F.when(F.col("block_height") != 330, F.col("self_bonded")).otherwise(F.col("tokens")).cast("decimal(38,0)"))


@pytest.mark.parametrize("kind", ["late", "early extra null", "dead amounts open"])
def test_corrections_equal_a_run_over_the_right_panel(spark, panel, top, three, expected, kind):
    wrong = written(damage(spark, panel, kind).select(panel.columns), "wrong")
    store = run(spark, wrong, top, ENDS[:3], last=False)
    changes = written(corrections.changed_rows(wrong, panel), "changes")
    assert changes.count() and tables(store) != three
    corrections.correct(panel, store, changes, TEST, chunk=TEST_CHUNK)
    assert tables(store) == three
    carried.advance(panel, store, ENDS[3], TEST, last=True, chunk=TEST_CHUNK)
    assert rows(store.labels()) == expected


def test_a_correction_reads_the_heights_around_it_and_replaces_those_labels(spark, panel, top, three):
    wrong = written(damage(spark, panel, "amounts").select(panel.columns), "wrong")
    store = run(spark, wrong, top, ENDS[:3], last=False)
    changes = written(corrections.changed_rows(wrong, panel), "changes")
    before = {r: r for r in rows(store.labels())}
    near = F.col("block_height").between(300, 365)
    unread = panel.withColumn("tokens", F.when(near, F.col("tokens")).otherwise(F.raise_error(F.lit("read")).cast("decimal(38,0)")))
    corrections.correct(unread, store, changes, TEST, chunk=TEST_CHUNK)
    assert tables(store) == three
    assert 0 < len(set(rows(store.labels())) - set(before)) < len(before) / 3


def test_a_killed_correction_is_repeated(spark, panel, top, three, monkeypatch):
    wrong = written(damage(spark, panel, "late").select(panel.columns), "wrong")
    store = run(spark, wrong, top, ENDS[:3], last=False)
    changes = written(corrections.changed_rows(wrong, panel), "changes")
    with monkeypatch.context() as patch:
        patch.setattr(carried.Store, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            corrections.correct(panel, store, changes, TEST, chunk=TEST_CHUNK)
    corrections.correct(panel, store, changes, TEST, chunk=TEST_CHUNK)
    assert tables(store) == three


def test_nothing_to_correct(spark, panel, top, three):
    store = run(spark, panel, top, ENDS[:3], last=False)
    corrections.correct(panel, store, corrections.changed_rows(panel, panel), TEST, chunk=TEST_CHUNK)
    assert tables(store) == three


def test_ranges_are_covered_by_a_bounded_number(spark):
    frame = spark.createDataFrame([(i * 37 % 5000, i * 37 % 5000 + i % 3) for i in range(2000)], "lo long, hi long")
    ranges = corrections.cover(frame)
    assert len(ranges) <= corrections.RANGES
    assert frame.filter(~F.col("lo").isin(-1)).count() == sum(
        frame.filter(F.col("lo").between(lo, hi) & (F.col("hi") <= hi)).count() for lo, hi in ranges)
    assert corrections.cover(spark.createDataFrame([(5, 9), (900, 901)], "lo long, hi long")) == [(5, 9), (900, 901)]
