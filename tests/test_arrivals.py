"""Labels of a panel that arrives as files against one run over the whole panel."""

import pytest

from stakescore import schemas
from stakescore.catalog.panels import TEST, TEST_CHUNK, weekly_panel
from stakescore.incremental import arrivals as module, carried, corrections
from stakescore.incremental.arrivals import Arrivals
from stakescore.plans import data_scoring as plans
from stakescore.staging import written
from tests.conftest import TESTDATA
from tests.test_carried import rows

@pytest.fixture(scope="module")
def panel(spark):
    return written(schemas.project(weekly_panel(spark, f"{TESTDATA}/sf0.001"), schemas.PANEL_SCHEMA), "panel")


@pytest.fixture(scope="module")
def top(spark, panel):
    return written(plans.survey(panel, TEST, chunk=TEST_CHUNK), "top")


@pytest.fixture(scope="module")
def expected(panel, top):
    return rows(schemas.project(plans.data_scoring(panel, TEST, top=top, chunk=TEST_CHUNK), schemas.BLOCK_LABEL_SCHEMA))


@pytest.fixture()
def folders(spark, panel, tmp_path):
    """The source (with a name that is not plain in an address), and the store; ``arrive`` adds files of some rows."""
    source, path = str(tmp_path / "new files 100%"), str(tmp_path / "store")

    def arrive(part):
        panel.filter(part).coalesce(2).write.mode("append").parquet(source)

    return source, path, arrive


def follow(spark, folders, **settings):
    return Arrivals(spark, folders[0], folders[1], TEST, chunk=TEST_CHUNK, **settings)


def test_three_arrivals_and_a_restart(spark, folders, top, expected):
    for low, high in ((0, 310), (310, 420), (420, 600)):
        folders[2](f"block_height > {low} and block_height <= {high}")
        taken = follow(spark, folders)  # without a given top set: the survey ends at 300
        taken.run()
        assert taken.store.last() < high
        before = taken.store._manifests()
        follow(spark, folders).run()  # nothing new
        assert taken.store._manifests() == before
    taken.finish()
    taken.finish()
    assert rows(taken.labels()) == expected


def test_late_files_and_waiting_for_the_survey(spark, folders, expected):
    late = "(block_height between 303 and 305 and hash(operator_address) % 2 = 0)"
    folders[2]("block_height <= 200")
    taken = follow(spark, folders)
    taken.run()
    assert taken.store.last() is None and taken.labels().count() == 0
    folders[2](f"block_height > 200 and block_height <= 400 and not {late}")
    taken.run()
    folders[2](late)  # nothing else: no increment, only a correction
    taken.run()
    folders[2]("block_height > 400")
    taken.run()
    taken.finish()
    assert rows(taken.labels()) == expected


def test_batches_of_few_files(spark, folders, top, expected):
    """One file at a time, in no order of heights: what comes below the heights done is late."""
    for part in ("< 25", ">= 25"):
        folders[2](f"block_height <= 330 and block_height % 40 {part}")
    folders[2]("block_height > 330")
    taken = follow(spark, folders, top=top, files_each=1, lag=5)
    taken.run()
    taken.finish()
    assert rows(taken.labels()) == expected
    assert taken._files().select("batch").distinct().count() > 1


@pytest.mark.parametrize("where", ["before the increment", "after the increment", "after the correction"])
def test_a_killed_run_is_repeated(spark, folders, top, expected, monkeypatch, where):
    late = "(block_height between 240 and 242 and hash(operator_address) % 2 = 0)"
    folders[2](f"block_height <= 330 and not {late}")
    follow(spark, folders, top=top).run()
    folders[2](f"{late} or block_height > 330")

    def killed(run, after):
        def call(*args, **settings):
            if after:
                run(*args, **settings)
            raise RuntimeError("killed")

        return call

    with monkeypatch.context() as patch:
        if where == "after the correction":
            patch.setattr(module.corrections, "correct", killed(corrections.correct, True))
        else:
            patch.setattr(module.carried, "advance", killed(carried.advance, where.startswith("after")))
        with pytest.raises(Exception, match="killed"):
            follow(spark, folders, top=top).run()
    taken = follow(spark, folders, top=top)
    taken.run()
    taken.finish()
    assert rows(taken.labels()) == expected


def test_an_increment_reads_the_files_of_its_window(spark, folders, top, monkeypatch):
    for low in range(150, 450, 50):
        folders[2](f"block_height > {low} and block_height <= {low + 50}")
    follow(spark, folders, top=top).run()
    folders[2]("block_height > 450")
    taken, read = follow(spark, folders, top=top), []
    panel = taken._panel
    monkeypatch.setattr(taken, "_panel", lambda low=None: read.append(panel(low)) or read[-1])
    taken.run()
    assert len(read) == 1 and len(read[0].inputFiles()) <= 4 < taken._files().count()


def test_no_files(spark, folders):
    folders[2]("block_height < 0")
    taken = follow(spark, folders)
    taken.run()
    taken.finish()
    assert taken.labels().count() == 0 and taken._files().count() == 0
    with pytest.raises(ValueError):
        follow(spark, folders, lag=-1)
