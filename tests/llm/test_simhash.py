"""Fingerprints, trees and groups against brute force."""

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from stakescore.llm import simhash
from stakescore.llm.components import components
from tests.llm.conftest import ODD_TEXTS


def plain_print(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ODD_TEXTS + ["a b c d e f g a b c d e", "x\x85y z\xa0w q r"])
def test_fingerprint(text):
    assert simhash.fingerprint(text, 4) == plain_print(text)


def near(a, b, radius=4):
    return (a ^ b).bit_count() <= radius


def plain_groups(prints, radius=4):
    """The smallest id that each id reaches."""
    ids = sorted(prints)
    smallest = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            best = min(smallest[j] for j in ids if near(prints[i], prints[j], radius))
            if best < smallest[i]:
                smallest[i], changed = best, True
    return smallest


def clustered(seed, centres=25, each=10):
    rng = np.random.default_rng(seed)
    found = set()
    for centre in rng.integers(0, 1 << 63, centres, dtype=np.uint64).tolist() + [0, (1 << 64) - 1]:
        value = centre
        for _ in range(each):
            found.add(value)
            for bit in rng.integers(0, 64, rng.integers(1, 7)):
                value ^= 1 << int(bit)
    return sorted(found)


@pytest.mark.parametrize("seed", range(3))
def test_trees_find_all_within_the_radius(seed):
    values = np.array(clustered(seed), np.uint64)
    shard = np.sort(np.unique(np.random.default_rng(seed).integers(0, 6, len(values)), return_inverse=True)[1])
    trees = simhash.Trees(shard, values)
    got = {(int(a), int(b)) for q, n in trees.search(values, trees.roots[shard], 4) for a, b in zip(q, n)}
    assert got == {
        (i, j) for i in range(len(values)) for j in range(len(values))
        if shard[i] == shard[j] and near(int(values[i]), int(values[j]))
    }


def test_children_are_keyed_by_distance():
    values = np.array(clustered(5), np.uint64)
    trees = simhash.Trees(np.zeros(len(values), int), values)
    for key, child in zip(trees.child_key, trees.child):
        assert (int(values[key // 65]) ^ int(values[child])).bit_count() == key % 65
    assert len(set(trees.child_key.tolist())) == len(trees.child) == len(values) - 1


@pytest.mark.parametrize("bands", [5, 6, 7])
def test_band_choices_leave_no_link_out(bands):
    rng = np.random.default_rng(bands)
    masks = simhash.band_masks(bands, 4)
    for _ in range(500):
        a = int(rng.integers(0, 1 << 63))
        b = a
        for bit in rng.choice(64, 4, replace=False):
            b ^= 1 << int(bit)
        assert any(a & m == b & m for m in masks)


@pytest.mark.parametrize("settings", [{}, {"BLOCK": 7, "SHARD": 1 << 60}, {"SHARD": 1}])
def test_groups_equal_brute_force(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(simhash, name, value)
    values = clustered(9, centres=12, each=8)
    prints = {3 * i + 1: v for i, v in enumerate(values)}
    frame = spark.createDataFrame(
        [(v - (1 << 64) if v >> 63 else v, i) for i, v in prints.items()], "fingerprint long, first long"
    )
    reached = dict(map(tuple, components(simhash.links(frame, 4), "one", "two").collect()))
    assert {i: reached.get(i, i) for i in prints} == plain_groups(prints)


def test_small_batches_of_units_give_the_same_links(monkeypatch):
    values = clustered(2, centres=8, each=6)
    table = pa.table({
        "unit": pa.array(sorted(i % 5 for i in range(len(values))), pa.int64()), "crossing": pa.array([False] * len(values)),
        "block": pa.array([0] * len(values), pa.int32()),
        "fingerprint": pa.array(np.array(values, np.uint64).view(np.int64)), "first": pa.array(range(len(values)), pa.int64()),
    })

    def linked():
        found = [b.to_pydict() for b in simhash._linked(iter(table.to_batches(max_chunksize=4)), 4)]
        return sorted(pair for b in found for pair in zip(b["one"], b["two"]))

    whole = linked()
    monkeypatch.setattr(simhash, "TOGETHER", 5)
    monkeypatch.setattr(simhash, "VISITS", 3)
    assert linked() == whole and whole


def test_documents(docs_of):
    base = " ".join(f"word{i % 97}{i % 13}" for i in range(400))
    rows = [(20 + i, t) for i, t in enumerate(ODD_TEXTS)] + [
        (9, base), (4, base), (11, base + " tail"), (12, "other " + base), (None, base), (5, "alone in the world today"), (5, base),
    ]
    got = [tuple(r) for r in simhash.near_duplicates(docs_of(rows)).collect()]
    assert len(got) == len(rows)
    prints = [(i, plain_print(t)) for i, t in rows]
    assert sorted((i, int(f, 16)) for i, f, _ in got if i is not None) == sorted(p for p in prints if p[0] is not None)
    # An id that repeats joins what its rows are near to only through their fingerprints.
    first = {}
    for i, p in prints:
        if i is not None:
            first[p] = min(i, first.get(p, i))
    reached = plain_groups({i: p for p, i in first.items()}) if len(set(first.values())) == len(first) else None
    for i, f, component in got:
        assert component is None if i is None else component <= i
        if i is not None and reached:
            assert component == reached[first[int(f, 16)]]


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).collect() == []


def test_query(spark, duck, sf_dir):
    from stakescore.llm.catalog import registered

    prints = {i: plain_print(t) for i, t in duck.sql("SELECT doc_id, text FROM documents").fetchall()}
    got = registered()["op2_simhash"](spark, sf_dir).collect()
    groups = plain_groups(prints)
    assert sorted(map(tuple, got)) == sorted((i, f"{p:016x}", groups[i]) for i, p in prints.items())


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 1), (2, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)]])
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    linked = {x for e in edges for x in e if e[0] != e[1]}
    want = {x: (min(linked) if linked else None) for x in linked}
    assert dict(map(tuple, components(frame, "a", "b").collect())) == want


def test_null_ends_are_no_links(spark):
    frame = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a long, b long")
    assert dict(map(tuple, components(frame, "a", "b").select("vertex", F.col("component")).collect())) == {3: 3, 4: 3}
