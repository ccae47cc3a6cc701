"""Vector codes and whitening against plain brute force."""

import hashlib
import math

import numpy as np
import pytest

from stakescore.llm import vector_codes, vectors, whitening

NAN, INF = float("nan"), float("inf")


def frame(spark, rows, partitions=3, kind="float"):
    """Vectors among columns whose names the operators use themselves."""
    filled = [(i, v, label, "s", 1, 2, "t", "c") for i, v, label in rows]
    return spark.createDataFrame(
        filled, f"vec_id long, embedding array<{kind}>, label int, state string, part int, place int, total string, code string"
    ).repartition(partitions)


def drawn(count, size, seed=1, spread=0.5):
    noise = np.random.default_rng(seed)
    centres = noise.normal(0, spread, (5, size))
    return [(i, [float(np.float32(x)) for x in centres[i % 5] + noise.normal(0, spread / 4, size)], None if i % 3 == 0 else i % 2) for i in range(count)]


ODD = [
    (900, None, 1), (901, [], 1), (902, [1.0] * 3, 1), (903, [NAN] + [0.0] * 15, 0), (904, [INF] + [0.0] * 15, 0), (905, [None] + [0.0] * 15, None),
]


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Every distance in every round, in Python's whole numbers."""
    kept = sorted((r for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    step = len(kept[0][1]) // parts
    cut = [[[math.floor(4096 * x) for x in v[p * step:(p + 1) * step]] for p in range(parts)] for _, v, _ in kept]
    books = [[cut[e][p] for e in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = [nearest(row[p], books[p])[1] for row in cut]
            for e in range(len(books[p])):
                own = [row[p] for row, code in zip(cut, of) if code == e]
                if own:
                    books[p][e] = [sum(column) // len(own) for column in zip(*own)]
    found = [[nearest(row[p], books[p]) for p in range(parts)] for row in cut]
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    errors = [sum(s for s, _ in row) for row in found]
    by_label = {}
    for (_, _, label), error in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + error
    long = lambda n: n if n < 1 << 63 else None
    return sorted(
        ((i, "".join(f"{e:02x}" for _, e in row), long(error), long(by_label[label]), digest)
         for (i, _, label), row, error in zip(kept, found, errors)), key=repr)


def coded(spark, rows, **settings):
    got = vector_codes.compress(frame(spark, rows, **settings))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("count, size", [(400, 16), (60, 64), (16, 8), (5, 16), (1, 8)])
def test_codes_equal_brute_force(spark, count, size):
    rows = drawn(count, size)
    assert coded(spark, rows) == plain_codes(rows)


def test_codes_of_odd_repeated_and_tied_vectors(spark):
    same = [(i % 7, [0.25 * (i % 3)] * 16, i % 2) for i in range(60)]  # ids and vectors repeat, distances tie
    rows = [*same, *drawn(40, 16, 3), (None, [0.5] * 16, None), (None, [-0.5] * 16, 1)]
    assert coded(spark, rows + ODD) == plain_codes(rows)


def test_codes_of_huge_components_are_exact(spark):
    rows = [(i, [1e9 * ((i * 7) % 11 - 5), 0.3] * 8, i % 2) for i in range(40)] + [(50, [1e15] * 16, 3)]
    assert coded(spark, rows, kind="double") == plain_codes(rows)


def test_codes_of_nothing(spark):
    assert coded(spark, ODD[:1] + ODD[3:]) == []
    assert coded(spark, []) == []
    with pytest.raises(ValueError):
        coded(spark, [(1, [1.0] * 9, 0)])


def test_bounds_are_used_and_hold():
    """In later rounds few parts are compared with all entries, and each code is the nearest entry nevertheless."""
    noise = np.random.default_rng(5)
    x = noise.integers(-2000, 2000, (12, 1, 4))[noise.integers(0, 12, 3000)] + noise.integers(-200, 200, (3000, 1, 4))
    history, state, compared = [np.ascontiguousarray(x[:16].transpose(1, 0, 2))], None, []
    for _ in range(7):
        state, some = vector_codes.assign(x, state, history, vector_codes.Displacements(history))
        squares = ((x[:, 0, None] - history[-1][0][None]) ** 2).sum(axis=2)
        assert (state["code"][:, 0] == squares.argmin(axis=1)).all()
        compared.append(some)
        book = history[-1].copy()
        for e in range(16):
            if (state["code"][:, 0] == e).any():
                own = x[state["code"][:, 0] == e, 0]
                book[0, e] = own.sum(axis=0) // len(own)
        history.append(book)
    assert compared[0] == 3000 and compared[-1] < 600


def test_net_displacement_forgets_moves_that_are_undone():
    there, back = np.zeros((1, 2, 2), np.int64), np.full((1, 2, 2), 50, np.int64)
    displaced = vector_codes.Displacements([there, back, there])
    assert displaced.own[0].max() == 0 and displaced.own[1].min() > 70


def white(spark, rows, **settings):
    got = whitening.whiten(frame(spark, rows, **settings))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return got.collect()


def plain_white(rows):
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v, _ in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = [[n * a - s for a, s in zip(row, sums)] for row in x]
    size = len(sums)
    products = [[sum(row[i] * row[j] for row in centred) / n**3 for j in range(size)] for i in range(size)]
    values, directions = np.linalg.eigh(np.array(products))
    order = np.argsort(-values)
    return centred, n, values[order], directions[:, order], float(np.trace(products))


@pytest.mark.parametrize("count, size", [(500, 40), (300, 6), (3, 5)])
def test_whitening_equals_brute_force(spark, count, size):
    rows = drawn(count, size, spread=3)
    centred, n, values, directions, trace = plain_white(rows)
    kept = min(32, size, n - 1)
    got = {(r["vec_id"], r["component"]): r for r in white(spark, rows)}
    assert set(got) == {(i, c) for i, _, _ in rows for c in range(1, kept + 1)}
    for c in range(kept):
        want = np.array(centred) / n @ directions[:, c] / math.sqrt(values[c])
        have = np.array([got[i, c + 1]["whitened"] for i, _, _ in rows])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-6
    for (i, c), r in got.items():
        assert r["n"] == n and r["deviation"] == sum(w * w for w in centred[i])
        assert r["explained"] == pytest.approx(values[c - 1] / trace, rel=1e-9) and r["identity_error"] < 1e-6
    assert len({r["identity_error"] for r in got.values()}) == 1


def test_polarised_sums_are_exact():
    """Covariances come from the squares of sums without loss, also far from the origin."""
    noise = np.random.default_rng(2)
    u = noise.integers(-50, 50, (1000, 7))
    u -= u.sum(axis=0) // 1000
    rests = [int(r) for r in u.sum(axis=0)]
    totals = {(i, j): int(((u[:, i] + (j > i) * u[:, j]) ** 2).sum()) for i in range(7) for j in range(i, 7)}
    assert np.allclose(whitening.covariance(totals, rests, 1000), np.cov(u.T, bias=True), rtol=1e-14, atol=1e-12)


def test_whitening_of_odd_rows(spark):
    rows = drawn(80, 16)
    rows += [(None, rows[0][1], 1), (3, rows[5][1], 1), (3, rows[5][1], 1)]
    got = white(spark, rows + ODD)
    assert len(got) == 83 * 16 and {r["n"] for r in got} == {83}
    assert white(spark, []) == [] and white(spark, ODD[:1]) == [] and white(spark, drawn(1, 16)) == []
    flat = [(i, [float(i % 5), 7.0, float(i % 3)], 0) for i in range(30)]  # a constant component
    assert {r["component"] for r in white(spark, flat)} == {1, 2}


def test_whitening_of_huge_components_is_exact(spark):
    rows = [(i, [1e12 * ((i * 7) % 11 - 5), 0.5 * i], 0) for i in range(40)]
    got = white(spark, rows, kind="double")
    assert {r["deviation"] for r in got} == {None} and {r["identity_error"] < 1e-4 for r in got} == {True}


def test_whole_numbers_are_floors():
    assert vectors.whole(np.array([[-0.1, 0.1, 2.0]]), 64.0).tolist() == [[-7, 6, 128]]
    assert vectors.whole(np.array([[2.0**60, -0.5]]), 64.0, 1).tolist() == [[2**66 + 1, -31]]
