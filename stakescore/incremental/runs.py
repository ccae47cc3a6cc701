"""Which heights are there, kept up to date as runs instead of found again among all rows.

A run (``_chunk``, ``first``, ``last``) stands for the heights first, first + stride, ..., last, all within one chunk of heights and
without another height between them. The runs of a table take one row for each gap and chunk, whatever its number of rows. New heights
touch few chunks: those are taken apart to heights (at most ``CHUNK`` each), joined with the new ones and put into runs again, and
written as a part of the store; the newest part that names a chunk counts. So an increment reads its own rows and the chunks that they fall into,
increments may come in any order or overlap, and repeating one changes nothing.

Gaps, strides, bounds and the number of heights follow from the runs alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stakescore.incremental.carried import Store
from stakescore.operators.chunked import chunk_of
from stakescore.schemas import HEIGHT

#: Heights per chunk; a table has at most 2^31 / CHUNK chunks.
CHUNK = 65_536


def runs_of(heights: DataFrame, stride: int = 1, clock: str = HEIGHT, chunk: int = CHUNK) -> DataFrame:
    """The runs of the distinct values of ``clock``; nulls count for nothing."""
    if stride < 1 or chunk < 1:
        raise ValueError("stride and chunk must be positive")
    at = F.col("_at")
    present = (
        heights.select(F.col(clock).cast("bigint").alias("_at")).filter(at.isNotNull()).distinct()
        .withColumn("_chunk", chunk_of(at, chunk))
    )
    ordered = Window.partitionBy("_chunk").orderBy("_at")
    begins = F.coalesce(at - F.lag("_at").over(ordered) != stride, F.lit(True))
    return (
        present.withColumn("_begins", begins.cast("int"))
        .withColumn("_run", F.sum("_begins").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("_chunk", "_run").agg(F.min("_at").alias("first"), F.max("_at").alias("last")).drop("_run")
    )


def heights_of(runs: DataFrame, stride: int, clock: str = HEIGHT) -> DataFrame:
    """The heights that runs stand for."""
    return runs.select(F.explode(F.sequence("first", "last", F.lit(stride).cast("bigint"))).alias(clock))


def steps(runs: DataFrame) -> DataFrame:
    """(previous_block, block, gap) from each run to the next one; the last of a chunk is followed by the first of the next chunk
    that has any, seen in a window over one row for each chunk.
    """
    ends = runs.groupBy("_chunk").agg(F.max("last").alias("_last"))
    before = ends.select("_chunk", F.lag("_last").over(Window.orderBy("_chunk")).alias("_before"))
    previous = F.lag("last").over(Window.partitionBy("_chunk").orderBy("first"))
    within = runs.withColumn("_previous", previous).join(before, "_chunk")
    return within.select(
        F.coalesce("_previous", "_before").cast("int").alias("previous_block"), F.col("first").cast("int").alias("block")
    ).filter("previous_block IS NOT NULL").withColumn("gap", F.col("block") - F.col("previous_block"))


def block_gaps(runs: DataFrame, stride: int = 1) -> DataFrame:
    """Neighbouring heights that are not ``stride`` apart, for runs of that stride."""
    return steps(runs).filter(F.col("gap") != stride)


def stride_histogram(runs: DataFrame, stride: int = 1) -> DataFrame:
    """How often each step between neighbouring heights occurs, for runs of ``stride``."""
    inside = runs.filter("last > first").select(
        F.lit(stride).alias("gap"), F.expr(f"(last - first) div {int(stride)}").alias("_pairs"))
    between = steps(runs).select("gap", F.lit(1).cast("bigint").alias("_pairs"))
    return inside.unionByName(between).groupBy("gap").agg(F.sum("_pairs").alias("pairs"))


def summary(runs: DataFrame, stride: int = 1) -> DataFrame:
    """(min_height, max_height, heights), for runs of ``stride``; nulls and 0 where there are none."""
    return runs.agg(
        F.min("first").cast("int").alias("min_height"), F.max("last").cast("int").alias("max_height"),
        F.coalesce(F.sum(F.expr(f"(last - first) div {int(stride)} + 1")), F.lit(0)).alias("heights"),
    )


class HeightRuns:
    """The runs of a table's heights, in a store below ``path``. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, stride: int = 1, clock: str = HEIGHT, chunk: int = CHUNK):
        self.spark, self.store = spark, Store(spark, path)
        self.stride, self.clock, self.chunk = stride, clock, chunk

    def _parts(self) -> DataFrame | None:
        """The parts by number, or nothing before the first increment."""
        return None if self.store.last() is None else self.store.table("runs")

    def _newest(self, parts: DataFrame) -> DataFrame:
        """Of each chunk the rows of the newest part that names it; a chunk that lost its heights is a row without a run."""
        newest = parts.groupBy("_chunk").agg(F.max("increment").alias("increment"))
        return parts.join(newest, ["_chunk", "increment"]).drop("increment").filter("first IS NOT NULL")

    def runs(self) -> DataFrame:
        """(_chunk, first, last): all runs."""
        parts = self._parts()
        if parts is None:
            return self.spark.createDataFrame([], "_chunk bigint, first bigint, last bigint")
        self._check(parts)
        return self._newest(parts).select("_chunk", "first", "last")

    def _check(self, parts: DataFrame) -> None:
        """The numbers a store was written with are those it is read with."""
        known = parts.select("stride", "chunk").first()
        if known and tuple(known) != (self.stride, self.chunk):
            raise ValueError(f"the store has stride and chunk {tuple(known)}, not {(self.stride, self.chunk)}")

    def _keep(self, runs: DataFrame, replaced: Sequence[str] = ()) -> None:
        """Write a part and name it, both or neither."""
        last = self.store.last()
        number = 0 if last is None else last + 1
        self.store.written = {}
        self.store.keep("runs", number, runs.withColumns({"stride": F.lit(self.stride), "chunk": F.lit(self.chunk)}))
        self.store.keep_state({}, number, replaced)

    def add(self, rows: DataFrame) -> None:
        """Note the heights of ``rows``, which is read twice unless no increment came before."""
        parts = self._parts()
        fresh = rows.select(F.col(self.clock).cast("bigint").alias(self.clock))
        if parts is not None:
            self._check(parts)
            touched = fresh.select(chunk_of(F.col(self.clock), self.chunk).alias("_chunk")).distinct()
            known = self._newest(parts).join(touched, "_chunk", "left_semi")
            fresh = fresh.unionByName(heights_of(known, self.stride, self.clock))
        self._keep(runs_of(fresh, self.stride, self.clock, self.chunk))

    def recount(self, rows: DataFrame, first: int, last: int) -> None:
        """Take the heights from ``first`` to ``last`` as ``rows`` now has them, after rows were withdrawn; of ``rows`` only these
        heights are read.
        """
        parts = self._parts()
        inside = F.col(self.clock).between(first, last)
        found = rows.filter(inside).select(F.col(self.clock).cast("bigint").alias(self.clock))
        spoiled = self._chunks(first, last)
        if parts is not None:
            self._check(parts)
            known = heights_of(self._newest(parts).join(spoiled, "_chunk", "left_semi"), self.stride, self.clock)
            found = found.unionByName(known.filter(~inside))
        # A chunk without any height stays as a row without a run, so that older parts of it no longer count.
        self._keep(spoiled.join(runs_of(found, self.stride, self.clock, self.chunk), "_chunk", "left"))

    def _chunks(self, first: int, last: int) -> DataFrame:
        def at(height: int) -> Column:
            return chunk_of(F.lit(height), self.chunk)

        return self.spark.range(1).select(F.explode(F.sequence(at(first), at(last))).alias("_chunk"))

    def compact(self) -> None:
        """Write all runs as one part that replaces the others; worth it after some hundred increments."""
        self._keep(self.runs(), replaced=("runs",))
