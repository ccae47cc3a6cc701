"""Run lists of heights against the distinct heights of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from stakescore.incremental import runs
from stakescore.operators import quality
from tests.conftest import rows_of


def frame(spark, heights):
    return spark.createDataFrame([(h,) for h in heights], "block_height int")


def some_heights(seed, low=-150, high=700):
    rng = random.Random(seed)
    return [h for h in range(low, high) if rng.random() < (0.97, 0.3, 0.0, 0.8)[h // 97 % 4]]


def gaps_of(heights, stride):
    ordered = sorted(set(heights))
    return sorted(((a, b, b - a) for a, b in zip(ordered, ordered[1:]) if b - a != stride), key=repr)


@pytest.mark.parametrize("stride, chunk", [(1, 64), (1, 1), (3, 50), (4, 1_000)])
def test_runs_stand_for_the_heights(spark, stride, chunk):
    heights = [h * 2 for h in some_heights(chunk)] + [h * stride + 1 for h in range(300)]
    found = runs.runs_of(frame(spark, heights + heights[:40] + [None]), stride, chunk=chunk)
    assert sorted(r[0] for r in runs.heights_of(found, stride).collect()) == sorted(set(heights))
    assert rows_of(runs.block_gaps(found, stride), "previous_block", "block", "gap") == gaps_of(heights, stride)
    plain = frame(spark, heights)
    assert rows_of(runs.stride_histogram(found, stride)) == rows_of(quality.stride_histogram(plain))
    assert tuple(runs.summary(found, stride).first()) == (min(heights), max(heights), len(set(heights)))


@pytest.mark.parametrize("seed, stride", [(1, 1), (2, 4)])
def test_any_split_into_increments(spark, tmp_path, seed, stride):
    rng = random.Random(seed)
    heights = some_heights(seed)
    kept = runs.HeightRuns(spark, str(tmp_path / "runs"), stride, chunk=64)
    for _ in range(3):
        kept.add(frame(spark, rng.sample(heights, len(heights) // 2)))
    kept.add(frame(spark, []))
    kept.add(frame(spark, heights))
    assert rows_of(runs.block_gaps(kept.runs(), stride), "previous_block", "block", "gap") == gaps_of(heights, stride)
    assert rows_of(kept.runs()) == rows_of(runs.runs_of(frame(spark, heights), stride, chunk=64))


def test_withdrawn_heights_and_emptied_chunks(spark, tmp_path):
    kept = runs.HeightRuns(spark, str(tmp_path / "runs"), chunk=10)
    kept.add(frame(spark, range(100)))
    left = [h for h in range(100) if not 25 <= h < 52]
    kept.recount(frame(spark, left), 25, 51)
    assert rows_of(runs.block_gaps(kept.runs())) == [(52, 28, 24)]
    kept.add(frame(spark, [33]))
    assert rows_of(runs.block_gaps(kept.runs()), "previous_block", "block") == [(24, 33), (33, 52)]
    kept.compact()
    assert kept.store.table("runs").select("increment").distinct().count() == 1
    assert rows_of(runs.block_gaps(kept.runs()), "previous_block", "block") == [(24, 33), (33, 52)]


def test_a_store_without_heights(spark, tmp_path):
    kept = runs.HeightRuns(spark, str(tmp_path / "runs"))
    assert kept.runs().count() == 0
    kept.add(frame(spark, []))
    kept.add(frame(spark, [None]))
    assert kept.runs().count() == 0 and runs.block_gaps(kept.runs()).count() == 0
    assert tuple(runs.summary(kept.runs()).first()) == (None, None, 0)


def test_a_killed_increment_counts_for_nothing(spark, tmp_path, monkeypatch):
    kept = runs.HeightRuns(spark, str(tmp_path / "runs"), chunk=10)
    kept.add(frame(spark, range(30)))

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(kept.store, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            kept.add(frame(spark, range(40, 50)))
    again = runs.HeightRuns(spark, str(tmp_path / "runs"), chunk=10)
    assert runs.summary(again.runs()).first().heights == 30
    again.add(frame(spark, range(40, 50)))
    assert rows_of(runs.block_gaps(again.runs()), "previous_block", "block") == [(29, 40)]


def test_other_numbers_than_the_store_s_are_an_error(spark, tmp_path):
    runs.HeightRuns(spark, str(tmp_path / "runs"), stride=4).add(frame(spark, [0, 4, 9]))
    with pytest.raises(ValueError, match="stride"):
        runs.HeightRuns(spark, str(tmp_path / "runs"), stride=1).runs()
    with pytest.raises(ValueError):
        runs.runs_of(frame(spark, [1]), 0)


def test_an_increment_reads_the_chunks_it_falls_into(spark, tmp_path):
    kept = runs.HeightRuns(spark, str(tmp_path / "runs"), chunk=10)
    kept.add(frame(spark, range(1_000)))
    kept.add(frame(spark, [1_003, 995]))
    newest = kept.store.table("runs").filter(F.col("increment") == 1)
    assert rows_of(newest.select("_chunk").distinct()) == [(100,), (99,)]
    assert rows_of(runs.block_gaps(kept.runs()), "previous_block", "block") == [(999, 1003)]
