"""Window operators over long ordered groups, in bounded pieces.

A group (a validator's history) is cut by its integer clock into chunks of ``chunk`` heights. With a
unique (clock, group) key a chunk has at most ``chunk`` rows, however long the history. Chunk totals
are aggregated first (map-side combined), summed up over a group's chunks, and joined back as the
chunk's starting offset; all sums are integers, so the result equals that of the unchunked window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column, DataFrame, Window, functions as F

from stakescore.schemas import HEIGHT

#: Heights per chunk. The offsets of one group are at most 2^31 / CHUNK rows, as heights are ints.
CHUNK = 16_384
#: Buckets per piece in the forward window.
LABEL_CHUNK = 16_384


def chunk_of(clock: Column, chunk: int) -> Column:
    clock = clock.cast("bigint")
    return F.floor((clock - F.pmod(clock, F.lit(chunk))) / F.lit(chunk)).cast("bigint")


@dataclass(frozen=True)
class Layout:
    """How the rows of a frame were placed beforehand: by ``CHUNK``, their chunk of heights, with copies of the last ``halo``
    heights before a chunk that are not at ``HOME`` there.
    """

    chunk: int = CHUNK
    halo: int = 0

    CHUNK: ClassVar[str] = "height_chunk"
    HOME: ClassVar[str] = "at_home"

    def __post_init__(self):
        if self.chunk < 1 or self.halo < 0:
            raise ValueError("chunk must be positive and halo not negative")

    def place(self, df: DataFrame, clock: str = HEIGHT) -> DataFrame:
        """The rows with their chunk, and copies of those in its halo; a halo longer than a chunk reaches several chunks ahead."""
        home, last = chunk_of(F.col(clock), self.chunk), chunk_of(F.col(clock).cast("bigint") + self.halo, self.chunk)
        placed = df.withColumn("_home", home).withColumn(self.CHUNK, F.explode(F.sequence(home, last)))
        return placed.withColumn(self.HOME, F.col(self.CHUNK) == F.col("_home")).drop("_home")

    def at_home(self, df: DataFrame) -> DataFrame:
        """The rows without the copies and without the columns of the layout."""
        return df.filter(self.HOME).drop(self.CHUNK, self.HOME)


def _no_key() -> Column:
    return F.raise_error(F.lit("block and validator are not a key: a validator has several rows at a height"))


def _rows_in_chunk(rows: Column, chunk: int) -> Column:
    """``rows``, or the error for copied keys where they exceed the chunk's heights. The totals are combined
    before the shuffle, so that no task sorts a large group of copies to the end.
    """
    return F.when(rows > chunk, _no_key().cast("bigint")).otherwise(rows)


def _single(copies: Column, position: Column) -> Column:
    """``position``, or the error for copied keys where a height has more than one row."""
    return F.when(copies > 1, _no_key().cast("bigint")).otherwise(position)


def _offsets(
    parts: DataFrame, group: Sequence[str], totals: dict[str, Column], rows_before: DataFrame | None = None
) -> DataFrame:
    """Per (group, _chunk): the totals of all earlier chunks of the group; ``_rows_before`` counts from the
    group's ``rows_before`` on.
    """
    earlier = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    summed = parts.groupBy(*group, "_chunk").agg(*[expr.alias(name) for name, expr in totals.items()])
    offsets = summed.select(
        *group, "_chunk",
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in totals],
    )
    if rows_before is None:
        return offsets
    known = rows_before.select(*group, F.col("rows_before").alias("_known"))
    counted = F.col("_rows_before") + F.coalesce("_known", F.lit(0))
    return offsets.join(known, group, "left").withColumn("_rows_before", counted).drop("_known")


def trailing_sum(
    df: DataFrame,
    points: str,
    win: int,
    group: Sequence[str],
    total: str,
    position: str,
    clock: str = HEIGHT,
    chunk: int = CHUNK,
    rows_before: DataFrame | None = None,
) -> DataFrame:
    """Add ``total``, the sum of ``points`` over clock values ``[h - win + 1, h]`` of the group, and
    ``position``, the row's 1-based number in its group.

    Every row adds its points at ``h`` and takes them off at ``h + win``, so the sum is a running sum and
    its cost does not depend on ``win``. ``points`` must be integer and not null. ``df`` is read three times,
    twice for the group, clock and points only: pass a table. If earlier rows are left out of ``df``,
    ``rows_before`` (the group and ``rows_before``) counts them. Copies of a (clock, group) key are an error.
    """
    group = list(group)
    if win < 1 or chunk < 1:
        raise ValueError("win and chunk must be positive")
    payload = [c for c in df.columns if c not in group]
    at, gain = F.col(clock).cast("bigint"), F.col(points).cast("bigint")

    # An expiry carries no row; as one struct the absent columns take a few bytes.
    starts = df.select(*group, at.alias("_at"), gain.alias("_delta"), F.struct(*payload).alias("_row"))
    no_row = F.lit(None).cast(starts.schema["_row"].dataType)
    expiries = df.select(*group, (at + win).alias("_at"), (-gain).alias("_delta"), no_row.alias("_row"))
    events = starts.unionByName(expiries).withColumn("_chunk", chunk_of(F.col("_at"), chunk))

    started = F.col("_shift") == 0
    narrow = df.select(
        *group, F.explode(F.array(F.lit(0), F.lit(win))).alias("_shift"), at.alias("_at"), gain.alias("_gain")
    ).select(
        *group,
        chunk_of(F.col("_at") + F.col("_shift"), chunk).alias("_chunk"),
        F.when(started, F.col("_gain")).otherwise(-F.col("_gain")).alias("_delta"),
        started.alias("_start"),
    )
    offsets = _offsets(narrow, group, {
        "_sum_before": F.sum("_delta"),
        "_rows_before": _rows_in_chunk(F.count_if("_start"), chunk),
    }, rows_before)

    running = (
        Window.partitionBy(*group, "_chunk").orderBy("_at")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same = Window.partitionBy(*group, "_chunk").orderBy("_at").rangeBetween(Window.currentRow, Window.currentRow)
    local = events.select(
        "*",
        F.sum("_delta").over(running).alias("_sum"),
        F.count("_row").over(running).alias("_rows"),
        F.count("_row").over(same).alias("_copies"),
    ).filter(F.col("_row").isNotNull())
    return local.join(offsets, [*group, "_chunk"]).select(
        *[F.col(c) if c in group else F.col(f"_row.{c}").alias(c) for c in df.columns],
        (F.col("_sum") + F.col("_sum_before")).alias(total),
        _single(F.col("_copies"), F.col("_rows") + F.col("_rows_before")).alias(position),
    )


def placed_trailing_sum(
    df: DataFrame,
    points: str,
    win: int,
    group: Sequence[str],
    total: str,
    position: str,
    layout: Layout,
    clock: str = HEIGHT,
    rows_before: DataFrame | None = None,
) -> DataFrame:
    """:func:`trailing_sum` of rows placed by ``layout``, whose ``halo`` must be ``win - 1`` at least: one window over each (group, chunk).

    The sum up to ``h`` less the sum up to ``h - win`` is taken with two frames that only grow, so the cost does not depend on ``win``.
    Where ``df`` is bucketed by group and chunk, its rows are not shuffled; the chunks' row counts are. Copies and the layout's
    columns are left out of the result.
    """
    group = list(group)
    if win < 1:
        raise ValueError("win must be positive")
    if layout.halo < win - 1:
        raise ValueError(f"a window of {win} heights needs a halo of {win - 1}, the layout has {layout.halo}")
    offsets = _offsets(
        df.select(*group, F.col(layout.CHUNK).alias("_chunk"), F.col(layout.HOME).alias("_home")), group,
        {"_rows_before": _rows_in_chunk(F.count_if("_home"), layout.chunk)}, rows_before,
    ).withColumnRenamed("_chunk", layout.CHUNK)
    by = Window.partitionBy(*group, layout.CHUNK).orderBy("_at")
    until_now = by.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    expired = by.rangeBetween(Window.unboundedPreceding, -win)
    same = by.rangeBetween(Window.currentRow, Window.currentRow)
    gain = F.col(points).cast("bigint")
    local = df.withColumn("_at", F.col(clock).cast("bigint")).select(
        "*",
        (F.sum(gain).over(until_now) - F.coalesce(F.sum(gain).over(expired), F.lit(0))).alias("_sum"),
        F.count_if(layout.HOME).over(until_now).alias("_rows"),
        F.count("*").over(same).alias("_copies"),
    ).filter(layout.HOME)
    return local.join(offsets, [*group, layout.CHUNK]).select(
        *[F.col(c) for c in df.columns if c not in (layout.CHUNK, layout.HOME)],
        F.col("_sum").alias(total),
        _single(F.col("_copies"), F.col("_rows") + F.col("_rows_before")).alias(position),
    )


def row_numbers(
    df: DataFrame, group: Sequence[str], position: str, clock: str = HEIGHT, chunk: int = CHUNK
) -> DataFrame:
    """Add ``position``, the row's 1-based number in its group by clock. Copies of a key are an error."""
    group = list(group)
    parts = df.withColumn("_chunk", chunk_of(F.col(clock), chunk))
    offsets = _offsets(parts, group, {"_rows_before": _rows_in_chunk(F.count("*"), chunk)})
    ordered = Window.partitionBy(*group, "_chunk").orderBy(clock)
    local = parts.withColumns({
        "_row": F.row_number().over(ordered),
        "_copies": F.when(F.lag(clock).over(ordered) == F.col(clock), 2).otherwise(1),
    })
    return local.join(offsets, [*group, "_chunk"]).select(
        *[F.col(c) for c in df.columns],
        _single(F.col("_copies"), F.col("_row") + F.col("_rows_before")).alias(position),
    )


def forward_mean(
    df: DataFrame,
    value: str,
    size: int,
    group: Sequence[str],
    index: str,
    out: str,
    chunk: int = LABEL_CHUNK,
) -> DataFrame:
    """Add ``out``: the mean of ``value`` over the current and the next ``size`` rows of the group, null
    where the row ``size`` ahead is missing or has no value.

    ``index`` must be dense in every group. A piece of the group is sorted together with the first ``size`` rows of the
    next piece, so its frames are whole. Values (below 10^15) are summed up as decimals of 18 digits behind the point: a
    running sum is exact, so a frame's sum is the difference of two of them, whatever its size and wherever pieces begin.
    """
    group = list(group)
    chunk = max(chunk, 8 * size)  # the repeated rows stay below an eighth
    home = chunk_of(F.col(index), chunk)
    repeated = F.pmod(F.col(index), F.lit(chunk)) < size
    pieces = df.withColumn("_home", home).withColumn(
        "_piece", F.explode(F.when(repeated, F.array(home, home - 1)).otherwise(F.array(home)))
    )
    ordered = Window.partitionBy(*group, "_piece").orderBy(index)
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exact = F.coalesce(F.col(value).cast("decimal(38,18)"), F.lit(0).cast("decimal(38,18)"))
    sums = pieces.withColumns({"_sum": F.sum(exact).over(running), "_count": F.count(value).over(running)})

    def ahead(column: str) -> Column:
        return F.lead(column, size).over(ordered) if size else F.col(column)

    total = (ahead("_sum") - F.col("_sum") + exact).cast("double")
    count = ahead("_count") - F.col("_count") + F.when(F.col(value).isNull(), 0).otherwise(1)
    return (
        sums.withColumn(out, F.when(ahead(value).isNotNull(), total / count))
        .filter(F.col("_piece") == F.col("_home"))
        .drop("_piece", "_home", "_sum", "_count")
    )


def adjacent_gaps(df: DataFrame, clock: str = HEIGHT, chunk: int = 65_536) -> DataFrame:
    """(previous_block, block, gap) for every pair of neighbouring distinct clock values.

    Neighbours within a chunk come from a window over at most ``chunk`` rows; the step from one
    occupied chunk to the next comes from the chunks' ends (at most 2^31 / chunk rows), seen in the same window.
    """
    heights = (
        df.select(F.col(clock).cast("int").alias("block")).filter(F.col("block").isNotNull()).distinct()
        .withColumn("_chunk", chunk_of(F.col("block"), chunk))
    )
    within = Window.partitionBy("_chunk")
    placed = heights.select(
        F.lag("block").over(within.orderBy("block")).alias("previous_block"), "block", "_chunk",
        F.max("block").over(within).alias("_last"),
    )
    # The first height of a chunk follows the last one of the chunk before.
    edges = placed.filter(F.col("previous_block").isNull()).select(
        F.lag("_last").over(Window.orderBy("_chunk")).alias("previous_block"), "block"
    )
    return (
        placed.select("previous_block", "block").unionByName(edges)
        .filter(F.col("previous_block").isNotNull())
        .withColumn("gap", F.col("block") - F.col("previous_block"))
    )
