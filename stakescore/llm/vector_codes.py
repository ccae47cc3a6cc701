"""Compression of vectors to short codes: one codebook for each of their parts, learned by exact rounds of k-means.

Components become whole numbers, so distances, sums and centres are exact and results do not depend on how rows are
dealt out. A round assigns every part to its nearest entry and moves each entry to the floor of its parts' mean.

Most assignments are proved unchanged without computing distances. Of each part the state holds an upper bound on
the distance to its entry and a lower bound on that to any other, each with the round in which it was measured. All
codebooks so far are kept, so a bound is carried to the present by the true net displacement of the entries between the two
rounds (the norm of the sum of their moves), which is tighter than the sum of the moves' norms: an entry that comes back costs
nothing. Where the bounds still touch, first the distance to the own entry is measured anew, and only then those to all
entries. Proofs are by strict inequality with a margin for rounding, so ties are always decided exactly.

A round is one pass over the state, a staged table that replaces the one before, and every task adds one row with its sums
by part and entry; these are combined before anything reaches the driver, which holds the codebooks only (fixed size). A
lost executor costs its tasks.

Nulls and ties: vectors that are null or hold a null or non-finite component are dropped, and so are those of another
length than the most frequent one; that length must be a multiple of the number of parts. A null id comes last among the first
entries, equal ids are taken by their vectors; with fewer rows than entries the codebooks are as short. Rows of equal id are coded each. An
empty table gives an empty result. An error beyond 64 bits is null. Columns of any name may be there; only the three named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stakescore import staging
from stakescore.llm.batches import batches_of
from stakescore.llm.vectors import decimals, finite, longs, matrix, narrowed, usual_length, whole
from stakescore.operators.skew import attach_by_key

SCALE, PARTS, ENTRIES, ROUNDS = 4096.0, 8, 16, 6
#: Relative slack of a bound, far above the rounding of its few operations.
SLACK = 1e-9
#: Rows worked on at once.
ROWS = 4096

#: Of a codebook: whole numbers by part, entry and place.
Codebooks = np.ndarray


def _squares(own: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to rows."""
    apart = own - entries
    return (apart * apart).sum(axis=-1)


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


class Displacements:
    """How far each entry lies now from where it was in an earlier round."""

    def __init__(self, history: list[Codebooks]):
        self.now = len(history) - 1
        moved = np.stack([_roots(_squares(book, history[-1])) for book in history])  # round, part, entry
        self.own = moved * (1 + SLACK)
        # The farthest net move among the other entries, for each entry.
        order = np.sort(moved, axis=2)
        first, second = order[:, :, -1:], order[:, :, -2:-1] if moved.shape[2] > 1 else np.zeros_like(order[:, :, -1:])
        self.others = np.where(moved == first, np.where((moved == first).sum(axis=2, keepdims=True) > 1, first, second), first) * (1 + SLACK)


def assign(
    x: np.ndarray, state: dict[str, np.ndarray] | None, history: list[Codebooks], displaced: Displacements,
) -> tuple[dict[str, np.ndarray], int]:
    """The state after assigning to the last of ``history``, and how many parts were compared with all entries.

    ``x``: rows by part and place. The state's arrays (code, upper, lower, upper_at, lower_at) are rows by part; None: no bounds.
    """
    now, books = displaced.now, history[-1]
    rows, parts = x.shape[:2]
    if state is None:
        state = {name: np.zeros((rows, parts), kind) for name, kind in STATE.items()}
        rescan = np.ones((rows, parts), bool)
    else:
        state = {name: values.copy() for name, values in state.items()}
        part = np.arange(parts)
        lower = state["lower"] * (1 - SLACK) - displaced.others[state["lower_at"], part, state["code"]]
        upper = state["upper"] * (1 + SLACK) + displaced.own[state["upper_at"], part, state["code"]]
        row, of = np.nonzero(upper >= lower)
        # Tighten the upper bound alone; where the part then is in the half nearer to its entry, it stays.
        exact = _roots(_squares(x[row, of], books[of, state["code"][row, of]]))
        state["upper"][row, of] = exact
        state["upper_at"][row, of] = now
        rescan = np.zeros((rows, parts), bool)
        rescan[row, of] = exact * (1 + SLACK) >= lower[row, of]
    compared = 0
    for p in range(parts):
        some = np.flatnonzero(rescan[:, p])
        if not len(some):
            continue
        compared += len(some)
        squares = _squares(x[some, p, None], books[p][None])
        best = np.argmin(squares, axis=1)  # the first of equal ones
        nearest = squares[np.arange(len(some)), best]
        state["code"][some, p] = best
        state["upper"][some, p] = _roots(nearest)
        if squares.shape[1] > 1:
            squares = squares.astype(np.float64)
            squares[np.arange(len(some)), best] = np.inf
            state["lower"][some, p] = np.sqrt(squares.min(axis=1))
        else:
            state["lower"][some, p] = np.inf
        state["upper_at"][some, p] = state["lower_at"][some, p] = now
    return state, compared


#: The state's arrays, as stored.
STATE = {"code": np.uint8, "upper": np.float64, "lower": np.float64, "upper_at": np.uint8, "lower_at": np.uint8}


def _pass(
    table: DataFrame, history: list[Codebooks], size: int, parts: int, last: bool,
) -> DataFrame:
    """One assignment of all rows. Not last: the rows with their new state, and by task rows with its sums (part, entry, place,
    total; place -1 counts). Last: vec_id, label, code and error.
    """
    bounded = "state" in table.columns
    kind = table.schema["vector"].dataType.simpleString()

    label = table.schema["label"].dataType.simpleString()
    fields = ", ".join(f"{name}: binary" for name in STATE)
    carried = StructType.fromDDL(f"vec_id bigint, label {label}, vector {kind}, state struct<{fields}>")
    absent = [(f.name, f.type) for f in to_arrow_schema(carried)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        displaced = Displacements(history)
        books = history[-1]
        sums = np.zeros((*books.shape[:2], books.shape[2] + 1), object)
        compared = 0
        for batch in batches_of(batches, ROWS):
            x = whole(matrix(batch.column("vector"), size), SCALE).reshape(batch.num_rows, parts, -1)
            state = None
            if bounded:
                state = {
                    name: np.frombuffer(b"".join(batch.column("state").field(name).to_pylist()), kind_).reshape(-1, parts)
                    for name, kind_ in STATE.items()
                }
            state, some = assign(x, state, history, displaced)
            compared += some
            code = state["code"]
            if last:
                error = _squares(x, books[np.arange(parts), code]).sum(axis=1)
                yield pa.record_batch({
                    "vec_id": batch.column("vec_id"), "label": batch.column("label"),
                    "code": pa.array([c.tobytes().hex() for c in code], pa.string()), "error": longs(error),
                })
                continue
            for p in range(parts):
                for entry in np.unique(code[:, p]):
                    of = x[code[:, p] == entry, p]
                    sums[p, entry, :-1] += of.sum(axis=0)
                    sums[p, entry, -1] += len(of)
            packed = {name: pa.array([v.tobytes() for v in values.astype(STATE[name])], pa.binary()) for name, values in state.items()}
            yield pa.record_batch({
                "vec_id": batch.column("vec_id"), "label": batch.column("label"), "vector": batch.column("vector"),
                "state": pa.StructArray.from_arrays(list(packed.values()), list(packed)),
                **{c: pa.nulls(batch.num_rows, t) for c, t in SUMS.items()},
            })
        if last:
            return
        part, entry, place = (a.ravel() for a in np.indices(sums.shape))
        met = np.flatnonzero(np.repeat((sums[:, :, -1] > 0).ravel(), sums.shape[2]))
        if len(met):
            place = np.where(place == sums.shape[2] - 1, -1, place)
            yield pa.record_batch({
                **{name: pa.nulls(len(met), type_) for name, type_ in absent},
                "part": pa.array(part[met], pa.int32()), "entry": pa.array(entry[met], pa.int32()),
                "place": pa.array(place[met], pa.int32()), "total": decimals(sums.ravel()[met]),
            })

    if last:
        return table.mapInArrow(rows, f"vec_id bigint, label {label}, code string, error bigint")
    return table.mapInArrow(rows, StructType(carried.fields + StructType.fromDDL(
        "part int, entry int, place int, total decimal(38,0)").fields))


#: The columns of a task's sums.
SUMS = {"part": pa.int32(), "entry": pa.int32(), "place": pa.int32(), "total": pa.decimal128(38, 0)}


def _moved(books: Codebooks, sums: list) -> Codebooks:
    """The floors of the entries' means; an entry without parts stays."""
    moved = books.astype(object)
    total = {(r["part"], r["entry"], r["place"]): int(r["total"]) for r in sums}
    for (part, entry, place), n in total.items():
        if place >= 0:
            moved[part, entry, place] = n // total[part, entry, -1]
    return narrowed(moved)


def fit(
    rows: DataFrame, size: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, list[Codebooks]]:
    """The codebooks of all rounds, the first included, and the staged state that carries the bounds of the last round.

    ``rows``: vec_id, label, vector (all of ``size`` components).
    """
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
    values = np.array([r["vector"] for r in first], np.float64).reshape(len(first), size)
    history = [narrowed(whole(values, SCALE).reshape(len(first), parts, -1).transpose(1, 0, 2))]
    state = rows
    for _ in range(rounds):
        after = staging.written(_pass(state, history, size, parts, last=False), "codes")
        if state is not rows:
            staging.discard(before)
        before = after
        sums = after.filter("part is not null").groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect()
        history.append(_moved(history[-1], sums))
        state = after.filter("part is null").select("vec_id", "label", "vector", "state")
    return state, history


def codebooks_digest(books: Codebooks) -> str:
    """SHA-256 of the components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(str(int(n)) for n in books.ravel()).encode()).hexdigest()


def compress(
    vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """Per row that takes part: vec_id, code (two hex digits a part), error (squared distance to what the code stands for),
    label_error (the error of all rows of its label; nulls together) and codebooks_sha256.

    Errors are summed up by label before the shuffle; rows of heavy labels are spread when the sums are joined back.
    """
    named = finite(vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector")), "vector")
    size = usual_length(named, "vector")
    if size % parts:
        raise ValueError(f"vectors of {size} components have no {parts} equal parts")
    if not size:
        return named.limit(0).select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("code", "string"), ("error", "bigint"), ("label_error", "bigint"), ("codebooks_sha256", "string"))])
    state, history = fit(named.filter(F.size("vector") == size), size, parts, entries, rounds)
    coded = staging.written(_pass(state, history, size, parts, last=True), "coded").select(
        "vec_id", "code", "error", F.col("label").isNull().alias("no_label"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("of_label"))
    staging.discard(state)
    key = ["no_label", "of_label"]
    by_label = staging.written(
        coded.groupBy(*key).agg(F.count("*").alias("weight"), F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error")), "labels")
    return attach_by_key(coded, by_label, key, "weight", ["vec_id", "code"]).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(history[-1])).alias("codebooks_sha256"))
