"""Nearest neighbours against brute force."""

import numpy as np
import pytest


from stakescore.llm import ann
from stakescore.llm.catalog import registered
from tests.conftest import TESTDATA

IS_QUERY = "vec_id % 20 = 0"


def plain(ids, vectors, queries, k):
    found = {}
    for q in queries:
        score = (vectors * vectors[ids.index(q)]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        found[q] = [(ids[i], score[i]) for i in order]
    return found


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, list int, score string").repartition(3)


def answers(df):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def recall(got, want):
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_recall_and_scores_at_scale(spark, duck_at):
    rows = duck_at("sf0.1").sql("SELECT vec_id, embedding FROM embeddings ORDER BY 1").fetchall()
    ids, vectors = [r[0] for r in rows], np.array([r[1] for r in rows], np.float32).astype(float)
    got = answers(registered()["op9_nearest_neighbours"](spark, f"{TESTDATA}/sf0.1"))
    want = plain(ids, vectors, [i for i in ids if i % 20 == 0], 20)
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values())
    assert recall(got, want) >= 0.9
    for q, found in got.items():
        for i, score in found:
            assert score == pytest.approx(vectors[ids.index(q)] @ vectors[ids.index(i)], abs=1e-12)


@pytest.mark.parametrize("settings", [{}, {"LIST_SIZE": 16}, {"LIST_SIZE": 4, "CHUNK": 8, "QUERY_CHUNK": 2}])
def test_vectors_of_any_length_and_many_equal_ones(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(ann, name, value)
    chance = np.random.default_rng(1)
    vectors = chance.normal(size=(300, 8)) * chance.uniform(0.1, 5, (300, 1))
    vectors[::3] = vectors[0]  # a third are one vector
    rows = [(i, v.tolist(), 1, "x") for i, v in enumerate(vectors)]
    got = answers(ann.nearest(frame(spark, rows), IS_QUERY, 20, vector="embedding"))
    want = plain(list(range(300)), vectors, range(0, 300, 20), 20)
    assert recall(got, want) >= 0.9
    for q in (0, 60, 120):  # ties go to the smaller id
        same = [i for i, s in want[q] if s == want[q][0][1]]
        assert [i for i, s in got[q]][: len(same)] == same


def test_vectors_that_take_no_part(spark):
    good = [(i, [1.0 + i, 2.0], 1, "x") for i in range(5)]
    bad = [(20, None, 1, "x"), (40, [0.0, 0.0], 1, "x"), (60, [float("nan"), 1.0], 1, "x"), (80, [float("inf"), 1.0], 1, "x"),
           (100, [None, 1.0], 1, "x"), (120, [1.0], 1, "x"), (None, [1.0, 1.0], 1, "x"), (140, [], 1, "x")]
    got = answers(ann.nearest(frame(spark, good + bad), IS_QUERY, 20, vector="embedding"))
    assert {q: [i for i, _ in found] for q, found in got.items()} == {0: [4, 3, 2, 1]}


def test_repeated_rows_are_one(spark):
    rows = [(0, [1.0, 0.0], 1, "x"), (0, [1.0, 0.0], 1, "x"), (1, [0.5, 0.5], 1, "x"), (1, [0.5, 0.5], 1, "x")]
    assert answers(ann.nearest(frame(spark, rows), IS_QUERY, 20, vector="embedding")) == {0: [(1, 0.5)]}


def test_no_vectors(spark):
    assert ann.nearest(frame(spark, []), IS_QUERY, 20, vector="embedding").collect() == []
    assert ann.nearest(frame(spark, [(0, [0.0], 1, "x")]), IS_QUERY, 20, vector="embedding").collect() == []
    assert ann.nearest(frame(spark, [(3, [1.0], 1, "x")]), IS_QUERY, 20, vector="embedding").collect() == []


def test_the_graph_finds_the_nearest_centroids():
    chance = np.random.default_rng(2)
    centroids = ann.halved(chance.normal(size=(4000, 16)), 256)
    assert len(centroids) == 256
    points = chance.normal(size=(200, 16))
    found, distance = ann.Graph(centroids).search(points, 32)
    exact = np.linalg.norm(points[:, None] - centroids, axis=2)
    assert np.mean(found[:, 0] == exact.argmin(axis=1)) > 0.95
    assert np.allclose(distance, np.take_along_axis(exact, found, 1))


def test_a_ratio_is_reached_beyond_for_every_point():
    chance = np.random.default_rng(4)
    graph = ann.Graph(ann.halved(chance.normal(size=(4000, 8)), 512))
    points = chance.normal(size=(50, 8))
    found, distance = graph.within(points, 1.6)
    exact = np.linalg.norm(points[:, None] - graph.centroids, axis=2)
    for i in range(len(points)):
        wanted = set(np.flatnonzero(exact[i] <= 1.6 * exact[i].min()).tolist())
        got = set(found[i][distance[i] <= 1.6 * distance[i, 0]].tolist())
        assert len(got & wanted) >= 0.95 * len(wanted)


def test_parts_are_balanced():
    points = np.random.default_rng(3).normal(size=(1000, 4))
    assert len(ann.halved(points, 8)) == 8
    assert len(ann.halved(np.ones((50, 3)), 8)) == 1
