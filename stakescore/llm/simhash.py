"""Near duplicates by SimHash fingerprints, searched in BK-trees.

A fingerprint has the bits that are set in over half of the XXH64 hashes of a text's word shingles. Two
fingerprints that differ in at most ``radius`` bits, cut into ``m`` bands, agree in at least ``m - radius``
of them; so for each choice of so many bands there is a table whose shards hold the fingerprints that agree
there. A shard's BK-tree (children keyed by their Hamming distance to the parent) is sent to the tasks that
hold its queries, and a query at distance d from a node follows only the edges from d - radius to
d + radius. Each task returns a spanning forest of the links it finds, never all pairs, and the components
of all forests are the groups.

Scale: equal texts have equal fingerprints, so a fingerprint counts once however many documents share it;
the number of bands grows with the number of fingerprints, so that shards stay small on average; a shard of
more than ``BLOCK`` fingerprints is cut into blocks, and each pair of blocks is a unit of its own. Nothing
but counts goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from stakescore import staging
from stakescore.llm.components import components

SEED = 42
#: Fingerprints of a shard that one tree holds.
BLOCK = 20_000
#: Fingerprints of a shard, on average, up to which fewer bands do.
SHARD = 64
#: Fingerprints whose trees are built together in a task.
TOGETHER = 200_000
#: Node visits worked on at once.
VISITS = 500_000


def fingerprint(text: str | None, width: int) -> int:
    """The fingerprint of a whole text; 0 if it has no word."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z, and white space \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(len(words) - width + 1, 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts[:last].tolist(), ends[-last:].tolist())], "<u8"
    )
    bits = np.zeros(64, np.int64)
    for at in range(0, last, 1 << 16):
        some = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits += some.sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > last, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, version of the text, fingerprint as a signed long), one row per document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, width) for t in batch.column(2).to_pylist()], "<u8")
            yield pa.record_batch({"doc_id": batch.column(0), "version": batch.column(1), "fingerprint": pa.array(prints.view("<i8"))})

    return docs.select(F.col(doc_id).cast("bigint"), F.xxhash64(text), text).mapInArrow(rows, "doc_id long, version long, fingerprint long")


class Trees:
    """The BK-trees of many shards, built level by level.

    All values of a shard that are not yet placed form a group; the first becomes a node, the rest are
    grouped by their distance to it, and each of these groups is a subtree below it.
    """

    def __init__(self, shard: np.ndarray, value: np.ndarray):
        """``shard``: dense numbers from 0; values are distinct within a shard."""
        count = len(value)
        self.value = value
        edge = np.zeros(count, np.int64)
        parent = np.full(count, -1, np.int64)
        waiting = np.argsort(shard, kind="stable")
        group = shard[waiting]
        self.roots = np.full(int(shard.max(initial=-1)) + 1, -1, np.int64)
        top = True
        while len(waiting):
            first = np.concatenate([[True], group[1:] != group[:-1]])
            nodes = waiting[first]
            if top:
                self.roots[group[first]] = nodes
                top = False
            above = nodes[np.cumsum(first) - 1][~first]
            waiting = waiting[~first]
            distance = np.bitwise_count(value[waiting] ^ value[above]).astype(np.int64)
            parent[waiting], edge[waiting] = above, distance
            key = above * 65 + distance
            order = np.argsort(key, kind="stable")
            waiting, group = waiting[order], key[order]
        # The last parent set is the node's own; nodes are their group's first, so none was moved on.
        placed = np.flatnonzero(parent >= 0)
        key = parent[placed] * 65 + edge[placed]
        order = np.argsort(key, kind="stable")
        self.child_key, self.child = key[order], placed[order]

    def search(self, query: np.ndarray, at: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index of the query and of the node, for all within ``radius`` of each other. ``at``: roots."""
        known = at >= 0
        stack = [(np.flatnonzero(known), at[known])]
        while stack:
            which, node = stack.pop()
            if len(which) > VISITS:
                half = len(which) // 2
                stack += [(which[:half], node[:half]), (which[half:], node[half:])]
                continue
            distance = np.bitwise_count(query[which] ^ self.value[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield which[near], node[near]
            low = np.searchsorted(self.child_key, node * 65 + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.child_key, node * 65 + np.minimum(distance + radius, 64), side="right")
            counts = high - low
            total = int(counts.sum())
            if total:
                begins = np.cumsum(counts) - counts
                below = self.child[np.arange(total) - np.repeat(begins - low, counts)]
                stack.append((np.repeat(which, counts), below))


class Forest:
    """Vertices joined so far; the label is the smallest index joined."""

    def __init__(self, count: int):
        self.label = np.arange(count)

    def join(self, one: np.ndarray, two: np.ndarray) -> None:
        while True:
            a, b = self.label[one], self.label[two]
            apart = a != b
            if not apart.any():
                return
            one, two = one[apart], two[apart]
            np.minimum.at(self.label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]


def _links(shard: np.ndarray, block: np.ndarray, crossing: np.ndarray, value: np.ndarray, first: np.ndarray, radius: int) -> np.ndarray:
    """Links that join the same vertices as all links within the units: rows of two ``first``.

    ``crossing`` units link their block 1 with their block 0; the others link block 0 with itself.
    """
    unit = np.concatenate([[0], np.cumsum(shard[1:] != shard[:-1])]) if len(shard) else shard
    forest = Forest(len(value))
    in_tree = np.flatnonzero(block == 0)
    trees = Trees(unit[in_tree], value[in_tree])
    asks = np.flatnonzero((block == 1) | ~crossing)
    roots = np.concatenate([trees.roots, np.full(int(unit.max(initial=-1)) + 1 - len(trees.roots), -1)])
    for which, node in trees.search(value[asks], roots[unit[asks]], radius):
        forest.join(asks[which], in_tree[node])
    moved = np.flatnonzero(forest.label != np.arange(len(value)))
    return np.stack([first[moved], first[forest.label[moved]]])


def _linked(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Units come sorted; whole units are worked on, as many at a time as ``TOGETHER`` rows hold."""

    def found(table: pa.Table) -> pa.RecordBatch:
        column = {n: table[n].to_numpy() for n in table.column_names}
        links = _links(column["unit"], column["block"], column["crossing"].astype(bool), column["fingerprint"].view("<u8"), column["first"], radius)
        return pa.record_batch({"one": pa.array(links[0], pa.int64()), "two": pa.array(links[1], pa.int64())})

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows > TOGETHER:
            table = pa.Table.from_batches(held).combine_chunks()
            unit = table["unit"].to_numpy()
            cut = int(np.searchsorted(unit, unit[-1]))
            if cut:
                yield found(table.slice(0, cut).combine_chunks())
            held = table.slice(cut).to_batches()
            rows -= cut
    if rows:
        yield found(pa.Table.from_batches(held).combine_chunks())


def band_masks(bands: int, radius: int) -> list[int]:
    """For each choice of ``bands - radius`` of the bands, the bits in them."""
    cuts = [64 * i // bands for i in range(bands + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(masks, bands - radius)]


def bands_for(count: int, radius: int) -> int:
    """The fewest bands whose shards hold ``SHARD`` fingerprints on average; all choices find all links."""
    bands = radius + 1
    while bands < radius + 4 and count > SHARD << (64 * (bands - radius) // bands):
        bands += 1
    return bands


def links(classes: DataFrame, radius: int) -> DataFrame:
    """(one, two): links that connect all classes (fingerprint, first) that a chain of near ones connects."""
    bands = bands_for(classes.count(), radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in band_masks(bands, radius)]
    shards = classes.select(
        "fingerprint", "first", F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in signed]))
    ).withColumnsRenamed({"pos": "band", "col": "key"})
    large = shards.groupBy("band", "key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).filter("blocks > 1")
    large = staging.written(large, "shards")
    blocks, own = F.coalesce("blocks", F.lit(1)), F.pmod(F.xxhash64("fingerprint"), F.coalesce("blocks", F.lit(1)).cast("bigint")).cast("int")
    units = shards.join(large, ["band", "key"], "left").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    ).select(
        F.xxhash64("band", "key", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
        (F.col("own") != F.col("other")).alias("crossing"), (F.col("own") > F.col("other")).cast("int").alias("block"),
        "fingerprint", "first",
    )
    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(
        lambda batches: _linked(batches, radius), "one long, two long"
    )


def near_duplicates(
    docs: DataFrame, width: int = 4, radius: int = 4, doc_id: str = "doc_id", text: str = "text", versions: bool = False,
) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable).

    A null text is an empty one, whose fingerprint is zero like that of any text without words; texts of
    fewer than ``width`` words have one shingle. Rows that share a doc_id are linked by their texts alone. A row
    of null doc_id links nothing and has a null component_id. Other columns are not read. With ``versions``
    also version (the text's XXH64 by Spark) and component (a number of the component itself, as those that
    share their smallest doc_id differ in it).
    """
    prints = staging.written(fingerprints(docs, width, doc_id, text), "fingerprints")
    classes = staging.written(
        prints.filter("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")),
        "classes",
    )
    # Fingerprints are the vertices: classes may share their first doc_id.
    reached = components(links(classes.select("fingerprint", F.col("fingerprint").alias("first")), radius), "one", "two")
    members = classes.join(reached, classes["fingerprint"] == reached["vertex"], "left").filter(
        "n > 1 or component is not null"
    ).select("fingerprint", "first", F.coalesce("component", "fingerprint").alias("component"))
    members = staging.written(members, "members")  # of documents that are alone, nothing
    least = members.groupBy("component").agg(F.min("first").alias("least"))
    grouped = staging.written(members.join(least, "component").select("fingerprint", "component", "least"), "grouped")
    return prints.join(grouped, "fingerprint", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"),
        *(["version", F.coalesce("component", "fingerprint").alias("component")] if versions else []),
    )
