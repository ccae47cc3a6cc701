"""The panel stored by validator and chunk of heights."""

import pytest
from pyspark.sql import functions as F

from stakescore.catalog.panels import TEST, weekly_panel
from stakescore.operators import scoring
from stakescore.operators.chunked import Layout, placed_trailing_sum, trailing_sum
from stakescore.plans import data_scoring as plans
from stakescore.schemas import HEIGHT, OPERATOR, PANEL_SCHEMA, project
from stakescore.sources import layout
from stakescore.sources.layout import StoredPanel
from tests.conftest import rows_of


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def points_of(df, *more):
    points = scoring.vote_points(scoring.clean(df), TEST.vote_score, TEST.propose_score)
    return points.select(HEIGHT, OPERATOR, "vote_propose_point", *more)


@pytest.fixture(scope="module")
def panel(spark, sf_dir):
    return project(weekly_panel(spark, sf_dir), PANEL_SCHEMA)


@pytest.fixture(scope="module")
def stored(spark, panel, tmp_path_factory):
    made = StoredPanel.create(spark, str(tmp_path_factory.mktemp("layout") / "panel"), Layout(64, 15), buckets=4)
    made.append(panel)
    return made


@pytest.fixture
def without_broadcast(spark):
    """The plan for chunk counts too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_come_back_once(panel, stored):
    assert rows_of(stored.rows()) == rows_of(panel)
    copies = stored.placed().filter(~F.col(Layout.HOME))
    assert 0 < copies.count() < stored.rows().count() * 0.3
    assert copies.filter(F.col(HEIGHT) < F.col(Layout.CHUNK) * 64 - 15).count() == 0


def test_the_activity_does_not_shuffle_the_panel(stored, without_broadcast):
    moved = scoring.moving_vote_sum(points_of(stored.placed(), Layout.CHUNK, Layout.HOME), 8, layout=stored.layout)
    plan = plan_of(moved)
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    # What is shuffled are chunk counts: by validator for their running sum, and back to the chunks.
    assert len(exchanges) == 2 and plan.count("Bucketed: true") == 2
    counts = plan.split("Exchange")[1:]
    assert "Window" in plan.split("Exchange")[0] and all("vote" not in part.split("FileScan")[0] for part in counts)


@pytest.mark.parametrize("win", [1, 8, 16])
def test_the_activity_is_that_of_the_plain_panel(panel, stored, win):
    placed = scoring.moving_vote_sum(points_of(stored.placed(), Layout.CHUNK, Layout.HOME), win, layout=stored.layout)
    assert rows_of(placed) == rows_of(scoring.moving_vote_sum(points_of(panel), win))


@pytest.mark.parametrize("chunk, halo, win", [(5, 11, 12), (7, 6, 7), (64, 0, 1), (1, 4, 5)])
def test_halos_longer_than_chunks(spark, tmp_path, panel, chunk, halo, win):
    small = panel.filter(F.col(HEIGHT).between(200, 260))
    stored = StoredPanel.create(spark, str(tmp_path / "panel"), Layout(chunk, halo), buckets=2)
    stored.append(small)
    terms = ("vote_propose_point", win, [OPERATOR], "total", "position")
    got = placed_trailing_sum(points_of(stored.placed(), Layout.CHUNK, Layout.HOME), *terms, stored.layout)
    assert rows_of(got) == rows_of(trailing_sum(points_of(small), *terms))


def test_loads_in_any_order_and_another_session_s_table(spark, tmp_path, panel):
    path = str(tmp_path / "panel")
    stored = StoredPanel.create(spark, path, Layout(32, 7), buckets=3)
    for part in (2, 0, 1):
        stored.append(panel.filter(F.col(HEIGHT) % 3 == part))
    again = StoredPanel.open(spark, path)
    assert (again.layout, again.buckets) == (Layout(32, 7), 3) and again.table != stored.table
    assert rows_of(again.rows()) == rows_of(panel)
    moved = scoring.moving_vote_sum(points_of(again.placed(), Layout.CHUNK, Layout.HOME), 8, layout=again.layout)
    assert rows_of(moved) == rows_of(scoring.moving_vote_sum(points_of(panel), 8))


def test_one_validator_is_spread_over_the_buckets(spark, tmp_path, panel_of):
    stored = StoredPanel.create(spark, str(tmp_path / "panel"), Layout(10, 0), buckets=4)
    stored.append(panel_of([{"block_height": h, "operator_address": "v"} for h in range(400)]))
    files = stored.placed().groupBy(F.input_file_name()).count().collect()
    assert len(files) == 4 and max(r[1] for r in files) < 250


def test_a_window_beyond_the_halo_and_copied_keys_are_errors(spark, tmp_path, stored, panel_of):
    with pytest.raises(ValueError, match="halo of 16"):
        scoring.moving_vote_sum(points_of(stored.placed(), Layout.CHUNK, Layout.HOME), 17, layout=stored.layout)
    with pytest.raises(ValueError):
        Layout(0, 3)
    twice = StoredPanel.create(spark, str(tmp_path / "panel"), Layout(64, 3), buckets=2)
    for _ in range(2):
        twice.append(panel_of([{"block_height": 5, "operator_address": "v"}]))
    moved = scoring.moving_vote_sum(points_of(twice.placed(), Layout.CHUNK, Layout.HOME), 2, layout=twice.layout)
    with pytest.raises(Exception, match="not a key"):
        moved.collect()


def test_an_empty_panel(spark, tmp_path, panel):
    stored = StoredPanel.create(spark, str(tmp_path / "panel"), Layout(64, 7), buckets=2)
    assert stored.rows().count() == 0
    stored.append(panel.limit(0))
    assert stored.rows().count() == 0 and stored.rows().columns == panel.columns


def test_heights_are_read_by_range(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_of(stored.rows().filter(F.col(HEIGHT).between(180, 300)).select(HEIGHT, "tokens"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(block_height,180)" in pushed and "EqualTo(at_home,true)" in pushed
    assert "ReadSchema: struct<block_height:int,tokens:decimal(38,0),at_home:boolean>" in pushed


def test_the_whole_run_shuffles_the_panel_for_block_values_only(panel, stored, without_broadcast):
    rows = plans.activity_rows(stored.placed(), TEST, (), layout=stored.layout)
    exchanged = [line for line in plan_of(rows).splitlines() if "Exchange" in line]
    assert len(exchanged) == 2 and plan_of(rows).count("Bucketed: true") == 2
    assert len(rows.columns) == 5


def test_a_load_is_dealt_by_its_rows_and_not_by_the_buckets(spark, tmp_path, panel, monkeypatch):
    monkeypatch.setattr(layout, "ROWS_PER_TASK", 300)
    stored = StoredPanel.create(spark, str(tmp_path / "panel"), Layout(16, 3), buckets=2)
    stored.append(panel)
    files = [r[1] for r in stored.placed().groupBy(F.input_file_name()).count().collect()]
    assert len(files) > 4 and max(files) < 1_000
    assert rows_of(stored.rows()) == rows_of(panel)
    moved = scoring.moving_vote_sum(points_of(stored.placed(), Layout.CHUNK, Layout.HOME), 4, layout=stored.layout)
    assert rows_of(moved) == rows_of(scoring.moving_vote_sum(points_of(panel), 4))


def test_buckets_grow_with_the_panel(spark, sf_dir, monkeypatch):
    from stakescore.catalog import queries

    assert [layout.buckets_for(n, 4) for n in (0, 4_000_000, 4_000_001)] == [4, 4, 5]
    monkeypatch.setattr(layout, "ROWS_PER_BUCKET", 200)
    stored = queries._laid_out(spark, sf_dir)
    assert stored.buckets > 4 and stored.rows().count() == weekly_panel(spark, sf_dir).count()
