"""Approximate nearest neighbours by inner product, with balanced posting lists.

Centroids come from a sample of at most ``SAMPLE`` vectors, which is halved at the median again and again, so
all lists are to hold about as many vectors. Every vector then goes to the list of its nearest centroid and,
if it lies near a boundary, to further ones (within a distance ratio, and not behind a centroid chosen
before). Centroids are searched by a neighbour graph in memory, whose size ``CENTROIDS`` bounds. A query
takes all lists whose centroids are within a distance ratio of its nearest; how large the ratio must be is
measured: at most ``TRIALS`` queries are compared with all vectors, in blocks, and the ratio is the smallest
at which the lists taken hold ``RECALL`` of their true neighbours.

Largest inner product becomes smallest distance by one more component, the root of M² - |x|², where M is the
largest norm. Scores are then taken on the original vectors in double precision.

Neighbouring lists form a group, which is searched at once: a query sees those of its lists. A group of any
size (one vector may be that of a third of all rows) is cut into chunks, and so are the queries that ask for
it; each pair of chunks is a unit of its own and returns at most k rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from stakescore import staging

SAMPLE = 50_000
LIST_SIZE, CENTROIDS = 256, 8_192
#: Lists of a vector at most, and how much farther than the nearest a further one may be.
REPLICAS, NEAR = 4, 1.10
#: Queries that the distance ratio is measured on, and the part of their neighbours to be found.
TRIALS, RECALL = 128, 0.96
DEGREE, ENTRIES, BEAM, OPENED = 24, 64, 64, 8
#: Neighbouring lists that are searched together, and vectors and queries of a unit at most.
GROUP, CHUNK, QUERY_CHUNK = 32, 32_768, 256


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector, norm2) without vectors that are null, zero, or hold nulls or non-finite numbers.

    Nor do vectors of another length than the most frequent one take part (of equally many, the shorter).
    """
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("vector")).filter(
        "vec_id is not null and vector is not null"
    ).filter(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.withColumn(
        "norm2", F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    ).filter("norm2 > 0")
    length = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("vector") == (length["d"] if length else 0))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def halved(points: np.ndarray, leaves: int) -> np.ndarray:
    """Means of about ``leaves`` equal parts: each is cut at the median between two far halves of itself."""
    parts, chance = [points], np.random.default_rng(3)
    while len(parts) < leaves and any(len(p) > 1 for p in parts):
        cut = []
        for part in parts:
            if len(part) < 2:
                cut.append(part)
                continue
            ends = part[chance.choice(len(part), 2, replace=False)]
            for _ in range(4):
                side = part @ (ends[1] - ends[0])
                above = side > np.median(side)
                if not above.any() or above.all():
                    break
                ends = np.stack([part[~above].mean(axis=0), part[above].mean(axis=0)])
            order = np.argsort(part @ (ends[1] - ends[0]), kind="stable")
            half = len(part) // 2
            cut += [part[order[:half]], part[order[half:]]]
        parts = cut
    means = np.stack([p.mean(axis=0) for p in parts])  # in this order, so that neighbours are near
    return means[np.sort(np.unique(means, axis=0, return_index=True)[1])]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0))


class Graph:
    """Centroids with links to their neighbours, searched from a few entries by a beam."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        count = len(centroids)
        degree = min(DEGREE, count - 1)
        self.links = np.zeros((count, degree), np.int32)
        for at in range(0, count, 1024):
            own = _distances(centroids[at : at + 1024], centroids)
            own[np.arange(len(own)), at + np.arange(len(own))] = np.inf
            if degree:
                self.links[at : at + 1024] = np.argpartition(own, degree - 1, axis=1)[:, :degree]
        self.entries = np.unique(np.linspace(0, count - 1, min(ENTRIES, count)).astype(np.int32))

    def search(self, points: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Per point the ``beam`` nearest centroids found and their distances, nearest first.

        The links of the nearest few centroids not yet opened are followed at a time, until all in the beam are.
        """
        count = len(points)
        beam = min(beam, len(self.centroids))
        rows = np.arange(count)[:, None]
        found = np.broadcast_to(self.entries, (count, len(self.entries)))
        distance = _distances(points, self.centroids[self.entries])
        opened = np.zeros((count, len(self.centroids)), bool)
        seen = opened.copy()
        seen[rows, found] = True
        lengths, norms = (points * points).sum(1), (self.centroids**2).sum(1)
        while True:
            order = np.argsort(distance, axis=1, kind="stable")[:, :beam]
            found, distance = np.take_along_axis(found, order, 1), np.take_along_axis(distance, order, 1)
            closed = ~opened[rows, found] & np.isfinite(distance)
            ask = np.flatnonzero(closed.any(axis=1))
            if not len(ask) or not self.links.shape[1]:
                return found, distance
            first = np.argsort(~closed[ask], axis=1, kind="stable")[:, :OPENED]
            at = found[ask[:, None], first]
            wanted = closed[ask[:, None], first]
            opened[ask[:, None], at] |= wanted
            near = self.links[at]
            near = np.where(wanted[:, :, None], near, at[:, :, None]).reshape(len(ask), -1)  # its own: seen already
            near.sort(axis=1)
            fresh = ~seen[ask[:, None], near]
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            seen[ask[:, None], near] = True
            row, col = np.nonzero(fresh)
            far = np.full(near.shape, np.inf)
            to = near[row, col]
            inner = np.einsum("nd,nd->n", points[ask[row]], self.centroids[to])
            far[row, col] = np.sqrt(np.maximum(lengths[ask[row]] + norms[to] - 2 * inner, 0))
            more = np.full((count, near.shape[1]), np.inf)
            more[ask] = far
            ids = np.zeros((count, near.shape[1]), np.int32)
            ids[ask] = near
            found, distance = np.concatenate([found, ids], 1), np.concatenate([distance, more], 1)

    def within(self, points: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`search`, with a beam that reaches beyond ``ratio`` times the nearest for every point."""
        beam = BEAM
        while True:
            found, distance = self.search(points, beam)
            if beam >= len(self.centroids) or (distance[:, -1] > ratio * distance[:, 0]).all():
                return found, distance
            beam *= 2


def _raised(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Candidates with the component that gives all of them the norm ``largest``."""
    rest = np.sqrt(np.maximum(largest**2 - (vectors**2).sum(axis=1), 0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def _asking(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Queries at the norm ``largest``, where nearest means largest inner product."""
    scaled = vectors * (largest / np.linalg.norm(vectors, axis=1))[:, None]
    return np.concatenate([scaled, np.zeros((len(vectors), 1))], axis=1)


def _postings(graph: Graph, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, list, and whether it is the row's nearest."""
    found, distance = graph.search(vectors, min(BEAM, 16))
    rows, lists, first = [np.arange(len(vectors))], [found[:, 0]], [np.ones(len(vectors), bool)]
    taken = [found[:, 0]]
    count = np.ones(len(vectors), int)
    for j in range(1, found.shape[1]):
        wanted = (distance[:, j] <= NEAR * distance[:, 0]) & (count < REPLICAS)
        for before in taken:  # a centroid nearer to a chosen one than to the vector adds little
            known = before >= 0
            apart = np.linalg.norm(graph.centroids[found[:, j]] - graph.centroids[np.maximum(before, 0)], axis=1)
            wanted &= ~known | (apart > distance[:, j])
        count += wanted
        taken.append(np.where(wanted, found[:, j], -1))
        at = np.flatnonzero(wanted)
        rows.append(at)
        lists.append(found[at, j])
        first.append(np.zeros(len(at), bool))
    return np.concatenate(rows), np.concatenate(lists), np.concatenate(first)


def _best(queries: pa.Table, postings: pa.Table, k: int) -> pa.Table:
    """The k best postings of each query, by exact scores; ties to the smaller id.

    If the queries have ``lists``, each is compared with the postings of its own lists only. A vector may be
    in several of them, and counts once.
    """
    asks, ids = queries["query_id"].to_numpy(), postings["vec_id"].to_numpy()
    q, x = _matrix(queries["vector"]), _matrix(postings["vector"])
    if not len(asks) or not len(ids):
        return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    score = q @ x.T
    copies = 1
    if "lists" in queries.column_names:
        copies = REPLICAS
        lists = queries["lists"].combine_chunks()
        asked = np.zeros((len(asks), GROUP), bool)
        asked[np.repeat(np.arange(len(asks)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy() % GROUP] = True
        score[~asked[:, postings["list"].to_numpy() % GROUP]] = -np.inf
    score[asks[:, None] == ids] = -np.inf
    most = copies * k
    least = np.partition(score, -most, axis=1)[:, -most] if len(ids) > most else np.full(len(asks), -np.inf)
    slack = 1e-9 * np.maximum(np.abs(score.max(axis=1, initial=0, where=np.isfinite(score))), 1e-300)
    row, col = np.nonzero(np.isfinite(score) & (score >= (least - slack)[:, None]))
    exact = np.empty(len(row))
    for at in range(0, len(row), 1 << 16):
        exact[at : at + (1 << 16)] = (q[row[at : at + (1 << 16)]] * x[col[at : at + (1 << 16)]]).sum(axis=1)
    found = ids[col]
    order = np.lexsort((found, -exact, row))
    row, found, exact = row[order], found[order], exact[order]
    again = np.zeros(len(row), bool)
    again[1:] = (row[1:] == row[:-1]) & (found[1:] == found[:-1]) & (exact[1:] == exact[:-1])
    row, found, exact = row[~again], found[~again], exact[~again]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return pa.table({"query_id": asks[row[kept]], "vec_id": found[kept], "score": exact[kept]})


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _top(scored: pa.Table, k: int) -> pa.Table:
    """The k best rows of each query."""
    query, score, ids = (scored[c].to_numpy() for c in ("query_id", "score", "vec_id"))
    order = np.lexsort((ids, -score, query))
    query = query[order]
    return scored.take(pa.array(order[np.arange(len(query)) - np.searchsorted(query, query) < k]))


def _ratio(graph: Graph, rows: DataFrame, trials: pa.Table, postings: DataFrame, largest: float, k: int) -> float:
    """The distance ratio at which the lists taken hold ``RECALL`` of the trials' true neighbours.

    All vectors are compared with the trials, batch by batch; at most k rows a trial and task are shuffled.
    """
    asks = trials.rename_columns(["query_id", "vector"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                found = _best(asks, pa.Table.from_batches([batch.slice(at, CHUNK)]), k)
                held = found if held is None else _top(pa.concat_tables([held, found]), k)
        if held is not None:
            yield from held.to_batches()

    truth = _ranked(rows.select("vec_id", "vector").mapInArrow(best, "query_id long, vec_id long, score double"), k)
    places = postings.select("vec_id", "list").join(F.broadcast(truth.select("query_id", "vec_id")), "vec_id").groupBy(
        "query_id", "vec_id").agg(F.collect_set("list").alias("lists")).collect()  # at most k * TRIALS rows
    distance = _distances(_asking(_matrix(asks["vector"]), largest), graph.centroids)
    ratios = distance / np.maximum(distance.min(axis=1, keepdims=True), 1e-12)
    number = {q: i for i, q in enumerate(asks["query_id"].to_pylist())}
    needed = sorted(ratios[number[r["query_id"]], r["lists"]].min() for r in places)
    return needed[min(len(needed) - 1, int(RECALL * len(needed)))] * (1 + 1e-9) if needed else 1.0


def nearest(vectors: DataFrame, is_query, k: int, vec_id: str = "vec_id", vector: str = "vector") -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k nearest found of each row for which ``is_query`` holds.

    ``is_query`` is a condition on ``vec_id``. A row is not a neighbour of itself, nor are others of its id;
    rows that repeat an id and vector are one. A query gets all candidates if there are fewer than k, and
    nothing if it takes no part (see :func:`usable`); an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = staging.written(usable(vectors, vec_id, vector).distinct(), "vectors")
    schema = "query_id long, rank int, vec_id long, score double"
    stats = rows.agg(F.count("*").alias("n"), F.sqrt(F.max("norm2")).alias("largest")).first()
    if not stats["n"]:
        return spark.createDataFrame([], schema)
    largest = stats["largest"]
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toArrow()
    leaves = max(1, min(CENTROIDS, stats["n"] // LIST_SIZE, sample.num_rows))
    graph = spark.sparkContext.broadcast(Graph(halved(np.unique(_raised(_matrix(sample["vector"]), largest), axis=0), leaves)))
    lists = len(graph.value.centroids)

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                row, to, first = _postings(graph.value, _raised(_matrix(part.column("vector")), largest))
                yield pa.record_batch({
                    "list": pa.array(to, pa.int32()), "first": pa.array(first), "vec_id": part.column("vec_id").take(pa.array(row)),
                    "vector": part.column("vector").take(pa.array(row)),
                })

    element = rows.schema["vector"].dataType.simpleString()
    postings = staging.written(
        rows.select("vec_id", "vector").mapInArrow(posted, f"list int, first boolean, vec_id long, vector {element}"), "postings"
    )
    sizes = np.zeros((lists, 2), np.int64)  # vectors of each list, and those that have no nearer list
    for r in postings.groupBy("list").agg(F.count("*").alias("n"), F.count_if("first").alias("own")).collect():
        sizes[r["list"]] = r["n"], r["own"]
    own = sizes[:, 1]
    trials = rows.filter(is_query).orderBy(F.xxhash64("vec_id"), "vec_id").limit(TRIALS).select("vec_id", "vector").toArrow()
    ratio = _ratio(graph.value, rows, trials, postings, largest, k) if trials.num_rows else 1.0

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found, distance = graph.value.within(_asking(_matrix(part.column("vector")), largest), ratio)
                held = np.cumsum(own[found], axis=1)
                few = held - own[found] <= k  # lists before hold too few vectors
                take = (distance <= ratio * distance[:, :1]) | few
                row, col = np.nonzero(take)
                to = found[row, col]
                lacking = np.flatnonzero(held[:, -1] <= k)  # then all lists
                kept = ~np.isin(row, lacking)
                row = np.concatenate([row[kept], np.repeat(lacking, lists)])
                to = np.concatenate([to[kept], np.tile(np.arange(lists, dtype=to.dtype), len(lacking))])
                order = np.lexsort((to, row))
                row, to = row[order], to[order]
                group = to // GROUP
                first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (group[1:] != group[:-1])])) if len(row) else row
                ends = np.append(first, len(row)).astype(np.int32)
                yield pa.record_batch({
                    "group": pa.array(group[first], pa.int32()), "query_id": part.column("vec_id").take(pa.array(row[first])),
                    "vector": part.column("vector").take(pa.array(row[first])),
                    "lists": pa.ListArray.from_arrays(pa.array(ends), pa.array(to, pa.int32())),
                })

    probes = staging.written(
        rows.filter(is_query).select("vec_id", "vector").mapInArrow(
            asked, f"group int, query_id long, vector {element}, lists array<int>"), "probes"
    )
    asks = {r["group"]: r["count"] for r in probes.groupBy("group").count().collect()}
    held_by = np.bincount(np.arange(lists) // GROUP, weights=sizes[:, 0]).astype(int)
    cuts = spark.createDataFrame(pa.table({
        "group": pa.array(asks, pa.int32()), "chunks": pa.array([max(1, -(-int(held_by[i]) // CHUNK)) for i in asks], pa.int32()),
        "parts": pa.array([-(-n // QUERY_CHUNK) for n in asks.values()], pa.int32()),
    }))
    cuts = F.broadcast(cuts)  # a row for each group at most

    def spread(df: DataFrame, own_id: str, own_count: str, own_name: str, other_count: str, other_name: str) -> DataFrame:
        own_part = F.pmod(F.xxhash64(own_id), F.col(own_count).cast("bigint")).cast("int")
        return df.join(cuts, "group").withColumn(own_name, own_part).withColumn(
            other_name, F.explode(F.sequence(F.lit(0), F.col(other_count) - 1))
        ).drop("chunks", "parts")

    unit = ["group", "chunk", "part"]
    grouped = postings.select(F.floor(F.col("list") / GROUP).cast("int").alias("group"), "list", "vec_id", "vector")
    left = spread(probes, "query_id", "parts", "part", "chunks", "chunk").groupBy(*unit)
    right = spread(grouped, "vec_id", "chunks", "chunk", "parts", "part").groupBy(*unit)
    scored = left.cogroup(right).applyInArrow(lambda a, b: _best(a, b, k), "query_id long, vec_id long, score double")
    return _ranked(scored, k).select("query_id", "rank", "vec_id", "score")
