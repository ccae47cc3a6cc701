"""Best-fit packing in bulk-synchronous rounds.

Items are to go into as few sequences of ``capacity`` as can be. In each round the items left and the gaps
of the open sequences are range-sorted by size, largest first. Every task sweeps its range: a gap met goes
on a stack, an item takes the gap on top, which is the smallest met that holds it (its successor). What a
range can't match is matched between ranges by rank: the items left over in a range, in order, take the gaps
left over before it, last first; only the counts by range pass the driver. Gaps are then updated, and the
rest goes into the next round. A gap that holds several of the largest items left offers a slot for each.

As many sequences are opened as the items' sum needs at least (or as there are items over half the
capacity), and more only when the items left outweigh the gaps left, or fit none. Rounds fall off
geometrically: about a dozen, whatever the number of items.

Any size may be that of a third of all items: ranges are cut by size and then by a hash, so equal sizes
spread, and a range holds ``RANGE`` rows, so small rounds take few tasks. Driver-side are counts by size (at most
``capacity`` of them) and by range. The state of a round is a table in the shared folder, so a lost executor costs only its
tasks; the rounds' pairs are read as one table in the end.

Nulls and ties: an item of null size, of less than 1 or more than ``capacity`` gets a null sequence and
offset; equal items are each placed; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from stakescore import staging
from stakescore.llm.word_ids import encoded

#: Rows of a range.
RANGE = 100_000

def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, doc_id: str = "doc_id", text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Every whole text as ids and ``end_id``, cut into pieces of ``capacity`` and a last, shorter one.

    Columns: doc_id, piece (from 0), start (ids before it in its document), length, ids_crc32 and, if asked
    for, ids. A null text is an empty one.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids in encoded(batches, tokenizer, end_id):
            counts = np.array([-(-len(x) // capacity) for x in ids], np.int64)
            cut = [x[i : i + capacity].astype("<u4") for x in ids for i in range(0, len(x), capacity)]
            piece = np.arange(len(cut)) - np.repeat(np.cumsum(counts) - counts, counts)
            columns = {
                "doc_id": batch.column(0).take(pa.array(np.repeat(np.arange(len(ids)), counts))),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(piece * capacity, pa.int64()),
                "length": pa.array([len(x) for x in cut], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(x) for x in cut], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(cut, pa.list_(pa.int64()))
            yield pa.record_batch(columns)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select(F.col(doc_id).cast("bigint"), text).mapInArrow(rows, schema)


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sweep one range, largest size first, slots before items of their size: pairs and what is left over."""
    from pyspark import TaskContext

    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    is_item = table["is_item"].to_numpy().astype(bool)
    height = np.cumsum(np.where(is_item, -1, 1))
    lowest = np.minimum.accumulate(np.minimum(height, 0))
    unmet = height < np.concatenate([[0], lowest[:-1]])  # items that come when the stack is empty
    level = height + is_item
    rest = np.flatnonzero(~unmet)
    rest = rest[np.lexsort((rest, level[rest]))]
    # Within a level slots and items alternate, so an item's slot is the row before it.
    meets = ~is_item[rest[:-1]] & is_item[rest[1:]] & (level[rest[:-1]] == level[rest[1:]])
    slots, items = rest[:-1][meets], rest[1:][meets]
    free = np.zeros(len(is_item), bool)
    free[~is_item] = True
    free[slots] = False
    part = TaskContext.get().partitionId()

    def rows(kind: str, items: np.ndarray | None, slots: np.ndarray | None) -> pa.RecordBatch:
        count = len(slots if items is None else items)

        def of(column: str, at: np.ndarray | None) -> pa.Array:
            data = table[column].combine_chunks()
            return pa.nulls(count, data.type) if at is None else data.take(pa.array(at))

        return pa.record_batch({
            "part": pa.array(np.full(count, part), pa.int32()), "kind": pa.array([kind] * count, pa.string()),
            "number": pa.array(np.arange(count), pa.int64()), "size": of("size", items), "item": of("item", items),
            "bin": of("bin", slots), "slot": of("slot", slots), "room": of("size", slots),
        })

    yield rows("pair", items, slots)
    yield rows("item", np.flatnonzero(unmet), None)
    yield rows("slot", None, np.flatnonzero(free))


def _between_ranges(left: dict[tuple[int, str], int]) -> list[tuple[int, int, int, int, int, int]]:
    """Item range, its first number, slot range, its last number, how many, and the number of the first match."""
    stack, matches, done = [], [], 0
    for part in sorted({p for p, _ in left}):
        wanted, first = left.get((part, "item"), 0), 0
        while wanted and stack:
            slot_part, top = stack.pop()
            met = min(wanted, top)
            matches.append((part, first, slot_part, top - 1, met, done))
            wanted, first, done = wanted - met, first + met, done + met
            if top > met:
                stack.append((slot_part, top - met))
        if free := left.get((part, "slot"), 0):
            stack.append((part, free))
    return matches


def _sizes(state: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Counts of the items and of the gaps, by size: at most ``capacity`` of each."""
    rows = state.filter(F.col("kind") != "pair").groupBy("kind", "size").count().collect()
    return tuple({r["size"]: r["count"] for r in rows if r["kind"] == kind} for kind in ("item", "bin"))


def _offered(items: dict[int, int], gaps: dict[int, int]) -> tuple[int, int, int]:
    """The smallest and the largest gap worth offering, and the slots that a gap may offer at most."""
    count, smallest, largest = sum(items.values()), min(items), max(items)
    enough, top = 0, max(gaps)
    for gap in sorted(g for g in gaps if g >= largest):
        enough += gaps[gap]
        if enough >= count:
            top = gap
            break
    bins = sum(n for gap, n in gaps.items() if smallest <= gap <= top)
    return smallest, top, -(-count // max(bins, 1)) + 1


def best_fit(items: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """``items`` with sequence_id (long) and offset (long, gapless from 0 in each sequence).

    Columns of these names that ``items`` has are replaced.
    """
    spark = items.sparkSession
    items = items.drop("sequence_id", "offset")
    item = F.struct(*[F.col(c) for c in items.columns])
    fits = F.coalesce(F.col(length).between(1, capacity), F.lit(False))
    item_type = items.select(item.alias("item")).schema["item"].dataType
    names = {"kind": StringType(), "turn": IntegerType(), "size": IntegerType(), "bin": LongType(), "slot": IntegerType(), "item": item_type}
    swept_type = StructType([
        StructField("part", IntegerType()), StructField("kind", StringType()), StructField("number", LongType()),
        StructField("size", IntegerType()), StructField("item", item_type), StructField("bin", LongType()),
        StructField("slot", IntegerType()), StructField("room", IntegerType()),
    ])

    def shaped(df: DataFrame, **columns) -> DataFrame:
        return df.select([
            columns.get(n, F.lit(None)).cast(t).alias(n) if not isinstance(t, StructType)
            else columns.get(n, F.lit(None).cast(t)).alias(n)
            for n, t in names.items()
        ])

    everything = staging.written(
        items.select(F.when(fits, F.lit("item")).alias("kind"), F.when(fits, F.col(length)).cast("int").alias("size"),
                     F.lit(None).cast("bigint").alias("bin"), F.lit(None).cast("int").alias("slot"), item.alias("item")),
        "items",
    )
    state = everything.filter(F.col("kind") == "item")
    waiting, gaps = _sizes(state)
    tables, opened, turn = [], 0, 0
    while waiting:
        total = sum(s * n for s, n in waiting.items())
        kept = {g: n for g, n in gaps.items() if g >= min(waiting)}
        new = max(0, -(-(total - sum(g * n for g, n in kept.items())) // capacity))
        if not turn:
            new = max(new, sum(n for s, n in waiting.items() if s > capacity // 2))
        if not new and max(kept, default=0) < min(waiting):
            new = -(-total // capacity)
        kept[capacity] = kept.get(capacity, 0) + new
        smallest, top, most_slots = _offered(waiting, kept)
        largest = max(waiting)
        bins = state.filter((F.col("kind") == "bin") & (F.col("size") >= smallest)).select("bin", "size").unionByName(
            spark.range(opened, opened + new).select(F.col("id").alias("bin"), F.lit(capacity).alias("size"))
        )
        opened += new

        gap = F.col("size")
        count = F.least(F.greatest(F.floor(gap / largest), F.lit(1)), F.lit(most_slots)).cast("int")
        slots = (
            bins.filter(gap <= top)
            .select("bin", gap, count.alias("count"), F.explode(F.sequence(F.lit(0), count - 1)).alias("slot"))
            .withColumn("size", F.when(F.col("slot") < F.col("count") - 1, F.lit(largest))
                        .otherwise(gap - (F.col("count") - 1) * largest).cast("int"))
        )
        both = slots.select(
            F.lit(0).alias("is_item"), "size", F.xxhash64("bin", "slot").alias("tie"), "bin", "slot",
            F.lit(None).cast(item_type).alias("item"),
        ).unionByName(state.filter(F.col("kind") == "item").select(
            F.lit(1).alias("is_item"), "size", F.xxhash64("item").alias("tie"),
            F.lit(None).cast("bigint").alias("bin"), F.lit(None).cast("int").alias("slot"), "item",
        ))
        order = [F.desc("size"), F.asc("is_item"), F.asc("tie")]
        offered = sum(n * min(max(g // largest, 1), most_slots) for g, n in kept.items() if smallest <= g <= top)
        ranges = -(-(sum(waiting.values()) + offered) // RANGE)
        swept = staging.written(
            both.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(_swept, swept_type)
            .withColumn("turn", F.lit(turn)), "swept"
        )
        left = {(r["part"], r["kind"]): r["count"]
                for r in swept.filter(F.col("kind") != "pair").groupBy("part", "kind").count().collect()}
        runs = np.array(_between_ranges(left), np.int64).reshape(-1, 6)
        matches = spark.createDataFrame(pa.table(dict(zip(("part", "first", "slot_part", "last", "met", "base"), runs.T))))
        loose = _numbered(swept.filter(F.col("kind") == "item"), matches.select(
            "part", F.col("first").alias("low"), (F.col("first") + F.col("met")).alias("high"),
            F.lit(1).alias("sign"), (F.col("base") - F.col("first")).alias("shift")))
        free = _numbered(swept.filter(F.col("kind") == "slot"), matches.select(
            F.col("slot_part").alias("part"), (F.col("last") + 1 - F.col("met")).alias("low"),
            (F.col("last") + 1).alias("high"), F.lit(-1).alias("sign"), (F.col("base") + F.col("last")).alias("shift")))
        met = loose.filter("match is not null").select("match", "size", "item").join(
            free.filter("match is not null").select("match", "bin", "slot", "room"), "match"
        )
        uses = swept.filter(F.col("kind") == "pair").select("bin", (F.col("room") - F.col("size")).alias("size")).unionByName(
            met.select("bin", (F.col("room") - F.col("size")).alias("size"))
        ).unionByName(free.filter("match is null").select("bin", F.col("room").alias("size")))
        gaps_left = uses.groupBy("bin").agg(F.sum("size").alias("size")).filter("size > 0").unionByName(
            bins.filter(gap > top).select("bin", F.col("size").cast("bigint").alias("size"))
        )
        state = staging.written(
            shaped(loose.filter("match is null"), kind=F.lit("item"), size=F.col("size"), item=F.col("item"))
            .unionByName(shaped(gaps_left, kind=F.lit("bin"), size=F.col("size"), bin=F.col("bin")))
            .unionByName(shaped(met, kind=F.lit("pair"), turn=F.lit(turn), size=F.col("size"), bin=F.col("bin"), slot=F.col("slot"), item=F.col("item"))),
            "packing",
        )
        tables += [swept, state]
        waiting, gaps = _sizes(state)
        turn += 1

    unfit = everything.filter("kind is null").select(
        "item.*", F.lit(None).cast("bigint").alias("sequence_id"), F.lit(None).cast("bigint").alias("offset")
    )
    if not tables:
        return unfit
    folders = sorted({f.rsplit("/", 1)[0] for table in tables for f in table.inputFiles()})
    placed = spark.read.schema(StructType([StructField(n, t) for n, t in names.items()])).parquet(*folders).filter("kind = 'pair'")
    before = Window.partitionBy("bin").orderBy("turn", "slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn(
        "before", F.coalesce(F.sum("size").over(before), F.lit(0))
    ).select("item.*", F.col("bin").alias("sequence_id"), F.col("before").alias("offset")).unionByName(unfit)


def _numbered(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """The match number of each row whose number lies in a run of its range; null for the others."""
    runs = F.broadcast(runs.withColumnRenamed("part", "run_part"))  # two for each range at most
    joined = rows.join(
        runs, (F.col("part") == F.col("run_part")) & (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high")), "left"
    )
    return joined.withColumn("match", F.col("sign") * F.col("number") + F.col("shift"))


def sequences(packed: DataFrame) -> DataFrame:
    """Per sequence its ids, from packed pieces that carry ``ids``; a group holds ``capacity`` ids at most."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.filter("sequence_id is not null").groupBy("sequence_id").agg(
        F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids")
    )
