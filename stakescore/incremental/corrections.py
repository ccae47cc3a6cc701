"""Corrected, late and withdrawn source rows: what a store of :mod:`carried` increments holds is put right again.

A changed row changes the totals of its own block, and its validator's activity for one activity window; so the values of those blocks are
computed anew and compared with the stored ones. Scores change for all validators at blocks whose values did change, and for the row's own validator during
that window. Full buckets cover a validator's heights without holes, so changed scores are traced to buckets, and those alone are scored and averaged again.
Where a bucket's number of rows has changed (a row came late, or its block came to life) all later buckets of that validator move, and that validator alone is bucketed again from there on.
Labels are made anew where they look at a changed bucket; the other buckets they look at come from the store.

Of the panel only height ranges around changes are read (``RANGES`` of them at most, close ones merged), and the moved validators' rows. Parts of
tables are written anew as a whole and count from the new state on; so a correction that was killed is repeated by running it again with the same changes.
The top set stays as it is. A store whose last increment closed short buckets cannot be corrected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from stakescore.incremental.carried import Store, bucketed, waiting
from stakescore.operators import labeling
from stakescore.operators.chunked import CHUNK, forward_mean, row_numbers
from stakescore.params import ScoringParams
from stakescore.plans import data_scoring as plans
from stakescore.schemas import BLOCK_LABEL_SCHEMA, HEIGHT, KEY, OPERATOR, PANEL_COLUMNS, project
from stakescore.staging import Stage, written

#: Height ranges of one scan.
RANGES = 64


def changed_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """(block_height, operator_address, delta): the keys whose row differs; delta is 1 for an added row, -1 for one
    withdrawn, else 0. Both frames may be cut to the heights in question.
    """
    columns = [c for c in old.columns if c not in KEY]
    sides = [df.select(*KEY, F.struct(*columns).alias(name)) for df, name in ((old, "_old"), (new, "_new"))]
    return sides[0].join(sides[1], list(KEY), "full").filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(
        *KEY, (F.col("_new").isNotNull().cast("int") - F.col("_old").isNotNull().cast("int")).alias("delta"))


def cover(ranges: DataFrame, most: int = RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges that cover those of ``ranges`` (lo, hi): of each of as many even cells the hull."""
    ends = ranges.agg(F.min("lo").alias("lo"), F.max("lo").alias("hi")).first()
    if ends.lo is None:
        return []
    cell = F.floor((F.col("lo") - ends.lo) / F.lit((ends.hi - ends.lo) // most + 1))
    found = sorted((r.lo, r.hi) for r in ranges.groupBy(cell.alias("cell")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect())
    merged: list[tuple[int, int]] = []
    for lo, hi in found:
        if merged and lo <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def within(ranges: list[tuple[int, int]], before: int = 0) -> Column:
    """Whether a row's height is in one of ``ranges``, or less than ``before`` heights ahead of it."""
    return reduce(Column.__or__, [F.col(HEIGHT).between(lo - before, hi) for lo, hi in ranges], F.lit(False))


def _cells(lo: Column, hi: Column, cell: int) -> Column:
    return F.explode(F.sequence(F.floor(lo / F.lit(cell)), F.floor(hi / F.lit(cell))))


def _touched(regions: DataFrame, ranges: DataFrame, cell: int) -> DataFrame:
    """The regions (operator_address, new_block, lo, hi) that meet one of ``ranges`` (operator_address or null for all, lo, hi).

    Both are cut into cells of heights and joined by cell; of a cell's ranges the hull counts, so no pairs multiply.
    """
    at = ranges.withColumn("_cell", _cells(F.col("lo"), F.col("hi"), cell)).groupBy(OPERATOR, "_cell").agg(
        F.min(F.greatest("lo", F.col("_cell") * cell)).alias("_lo"), F.max(F.least("hi", F.col("_cell") * cell + cell - 1)).alias("_hi"))
    cut = regions.withColumn("_cell", _cells(F.col("lo"), F.col("hi"), cell))
    meets = (F.col("lo") <= F.col("_hi")) & (F.col("hi") >= F.col("_lo"))
    for_all = cut.join(at.filter(F.col(OPERATOR).isNull()).drop(OPERATOR), "_cell")
    own = cut.join(at, [OPERATOR, "_cell"])
    return for_all.unionByName(own).filter(meets).select(*regions.columns).distinct()


class _Correction:
    """The frames of one correction, each staged as it is made."""

    def __init__(self, panel: DataFrame, store: Store, changes: DataFrame, params: ScoringParams, stage: Stage, chunk: int):
        self.store, self.params, self.stage, self.chunk = store, params, stage, chunk
        self.win, self.size = params.vote_proposed_win_size, params.combine_win_size
        store.written = {}
        self.end = store.last()
        self.state = store.state()
        self.panel = panel.filter(F.col(HEIGHT) <= self.end)
        self.changes = stage(changes.filter(F.col(HEIGHT) <= self.end).select(
            F.col(HEIGHT).cast("bigint").alias("lo"), OPERATOR, "delta"), "changes")

    def validators(self) -> DataFrame:
        """The state's validators with corrected counts, and with ``was_warm``, their former warm-up height.

        Only those whose number of rows changed before they were warm are numbered again, by their keys.
        """
        next_low = self.end - self.win + 2
        counted = self.changes.groupBy(OPERATOR).agg(
            F.sum(F.when(F.col("lo") < next_low, F.col("delta")).otherwise(0)).alias("_more"), F.min(F.when(F.col("delta") != 0, F.col("lo"))).alias("_first"))
        joined = self.state["validators"].withColumnRenamed("warm_from", "was_warm").join(counted, OPERATOR, "full")
        moved = F.col("_first").isNotNull() & (F.col("was_warm").isNull() | (F.col("_first") <= F.col("was_warm")))
        joined = self.stage(joined.withColumn("_moved", moved), "validators")
        found = joined.withColumn("warm_from", F.col("was_warm"))
        if joined.filter("_moved").limit(1).count():
            keys = self.panel.select(*KEY).join(joined.filter("_moved").select(OPERATOR), OPERATOR, "left_semi")
            warm = row_numbers(keys, [OPERATOR], "_position", chunk=self.chunk).filter(F.col("_position") == self.win)
            found = joined.join(warm.select(OPERATOR, F.col(HEIGHT).alias("_warm")), OPERATOR, "left").withColumn(
                "warm_from", F.when(F.col("_moved"), F.col("_warm")).otherwise(F.col("was_warm")))
        return self.stage(found.select(
            OPERATOR, (F.coalesce("rows_before", F.lit(0)) + F.coalesce("_more", F.lit(0))).alias("rows_before"), "warm_from", "was_warm",
            F.coalesce("closed", F.lit(0)).cast("bigint").alias("closed")), "validators")

    def ranges(self, validators: DataFrame) -> DataFrame:
        """(operator_address, lo, hi): where a validator's own activity or warm-up may have changed."""
        until = F.lit(self.end).cast("bigint")
        own = self.changes.select(OPERATOR, "lo", F.least(F.col("lo") + self.win - 1, until).alias("hi"))
        warm = validators.filter(~F.col("warm_from").eqNullSafe(F.col("was_warm"))).select(
            OPERATOR, F.least("warm_from", "was_warm").cast("bigint").alias("lo"),
            F.coalesce(F.when(F.col("warm_from").isNotNull() & F.col("was_warm").isNotNull(), F.greatest("warm_from", "was_warm")), until).cast("bigint").alias("hi"))
        return self.stage(own.unionByName(warm), "ranges")

    def activity(self, ranges: list[tuple[int, int]], validators: DataFrame, of: DataFrame | None = None, columns=()) -> DataFrame:
        """Activity rows of complete, warm rows within ``ranges``; the panel is read there and one activity window before."""
        rows = self.panel.filter(within(ranges, self.win - 1))
        if of is not None:
            rows = self.stage(rows.select(*PANEL_COLUMNS).join(of.select(OPERATOR).distinct(), OPERATOR, "left_semi"), "own")
        found = plans.activity_once(rows, self.params, columns, self.chunk).filter(F.col("_complete") & within(ranges))
        warm = validators.filter("warm_from is not null").select(OPERATOR, "warm_from")
        return found.join(warm, OPERATOR).filter(F.col(HEIGHT) >= F.col("warm_from")).drop("warm_from")

    def blocks(self, dirty: list[tuple[int, int]], validators: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """All blocks as corrected, the new ones within ``dirty``, and the heights among them whose values changed."""
        stored = self.store.table("blocks").drop("increment")
        fresh = self.stage(plans.block_values(
            plans.total_values(self.panel.filter(within(dirty))), plans.largest_activity(self.activity(dirty, validators)), self.params), "blocks")
        values = F.struct(*[c for c in fresh.columns if c not in (HEIGHT, "_weight")])
        sides = [df.select(HEIGHT, values.alias(name)) for df, name in ((stored.filter(within(dirty)), "_old"), (fresh, "_new"))]
        differ = sides[0].join(sides[1], HEIGHT, "full").filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(F.col(HEIGHT).cast("bigint").alias("lo"))
        return stored.filter(~within(dirty)).unionByName(fresh), fresh, self.stage(differ, "differ")

    def regions(self, buckets: DataFrame, validators: DataFrame) -> DataFrame:
        """(operator_address, new_block, lo, hi): the heights of every bucket up to the next one's, with those of the open one, and as
        number -1 the warm heights before the first.
        """
        starts = buckets.select(OPERATOR, "new_block", F.col(HEIGHT).cast("bigint").alias("lo"))
        closed = buckets.groupBy(OPERATOR).agg((F.max("new_block") + 1).alias("new_block"))
        begun = self.state["open"].groupBy(OPERATOR).agg(F.min(HEIGHT).cast("bigint").alias("lo"))
        opened = begun.join(closed, OPERATOR, "left").select(OPERATOR, F.coalesce("new_block", F.lit(0)).alias("new_block"), "lo")
        warm = validators.filter("warm_from is not null").select(OPERATOR, F.lit(-1).cast("bigint").alias("new_block"), F.col("warm_from").cast("bigint").alias("lo"))
        if "top" in self.state:
            warm = warm.join(self.state["top"], OPERATOR, "left_semi")
        following = F.lead("lo").over(Window.partitionBy(OPERATOR).orderBy("new_block"))
        return starts.unionByName(opened).unionByName(warm).withColumn(
            "hi", F.coalesce(following - 1, F.lit(self.end).cast("bigint"))).filter("lo <= hi")

    def scored(self, ranges: list[tuple[int, int]], validators: DataFrame, of: DataFrame, blocks: DataFrame) -> DataFrame:
        return plans.scored_rows(self.activity(ranges, validators, of, plans.LABEL_COLUMNS), blocks, self.params)


def correct(
    panel: DataFrame, store: Store, changes: DataFrame, params: ScoringParams, stage: Stage = written, chunk: int = CHUNK,
) -> None:
    """Put the store right after the rows that ``changes`` names (:func:`changed_rows`) have changed in ``panel``.

    Changes above the last increment's height are left to the next one. Then the store holds what increments over the
    corrected panel would have put there, but for the increment that a moved label is filed under.
    """
    run = _Correction(panel, store, changes, params, stage, chunk)
    validators = run.validators()
    own = run.ranges(validators)
    dirty = cover(own)
    if not dirty:
        return
    blocks, fresh, differ = run.blocks(dirty, validators)
    old = stage(store.table("buckets"), "buckets")
    anywhere = differ.select(F.lit(None).cast("string").alias(OPERATOR), "lo", F.col("lo").alias("hi"))
    cell = max(run.win, run.size, 64)
    regions = stage(_touched(run.regions(old, validators), own.unionByName(anywhere), cell), "regions")

    # The rows of the regions touched, and the first region of each validator whose number of rows is not its own.
    ranges = cover(regions)
    rows = run.scored(ranges, validators, regions, blocks).withColumn("_cell", F.floor(F.col(HEIGHT) / F.lit(cell)))
    cut = regions.withColumn("_cell", _cells(F.col("lo"), F.col("hi"), cell))
    rows = stage(rows.join(cut, [OPERATOR, "_cell"]).filter(F.col(HEIGHT).between(F.col("lo"), F.col("hi"))).drop("_cell", "lo", "hi"), "scored")
    averages = [F.avg(c).alias(c) for c in labeling.BUCKET_MEANS]
    found = rows.groupBy(OPERATOR, "new_block").agg(F.count("*").alias("_rows"), F.min(HEIGHT).alias(HEIGHT), *averages)
    full = old.select(OPERATOR, "new_block", F.lit(True).alias("_full"))
    found = stage(regions.join(full, [OPERATOR, "new_block"], "left").join(found, [OPERATOR, "new_block"], "left").withColumn("_rows", F.coalesce("_rows", F.lit(0))), "found")
    wrong = F.when(F.col("new_block") < 0, F.col("_rows") > 0).when(F.col("_full"), F.col("_rows") != run.size).otherwise(F.col("_rows") >= run.size)
    moved = stage(found.filter(wrong).groupBy(OPERATOR).agg(
        F.min("lo").alias("_from"), F.greatest(F.min("new_block"), F.lit(0)).alias("closed")), "moved")

    # Buckets in place, and all later ones of the validators that moved.
    in_place = found.filter("_full and _rows > 0").join(moved, OPERATOR, "left").filter("closed is null or new_block < closed")
    shape = [c for c in old.columns if c != "increment"]
    tail = cover(moved.select(F.col("_from").alias("lo"), F.lit(run.end).cast("bigint").alias("hi")))
    rebuilt = run.scored(tail, validators, moved, blocks).join(moved.select(OPERATOR, "_from"), OPERATOR).filter(F.col(HEIGHT) >= F.col("_from")).drop("_from")
    anew = bucketed(stage(rebuilt, "scored"), moved.select(OPERATOR, "closed"), params, stage, chunk)
    now = stage(in_place.select(*shape).unionByName(anew.full.select(*shape)), "replaced")
    gone = stage(
        old.join(moved.select(OPERATOR, "closed"), OPERATOR).filter(F.col("new_block") >= F.col("closed")).select(OPERATOR, "new_block", HEIGHT, "increment")
        .unionByName(old.join(in_place.select(OPERATOR, "new_block"), [OPERATOR, "new_block"], "left_semi").select(OPERATOR, "new_block", HEIGHT, "increment")), "gone")
    buckets, old_labels = _replaced(old, now, gone, [OPERATOR, "new_block"], run.end, stage), store.table("labels")

    # Labels that look at a bucket replaced or gone.
    ahead = params.label_win_size // run.size
    hull = stage(now.select(OPERATOR, "new_block").unionByName(gone.select(OPERATOR, "new_block")).groupBy(OPERATOR).agg(
        (F.min("new_block") - ahead).alias("_lo"), F.max("new_block").alias("_hi")), "hull")
    near = buckets.join(hull, OPERATOR).filter(F.col("new_block").between(F.col("_lo"), F.col("_hi") + ahead))
    made = forward_mean(near.drop("_lo", "_hi", "increment"), "score", ahead, [OPERATOR], "new_block", "label").na.drop()
    labels = stage(project(made.join(hull, OPERATOR).filter(F.col("new_block") <= F.col("_hi")), BLOCK_LABEL_SCHEMA), "labels")
    looked = old.join(hull, OPERATOR).filter(F.col("new_block").between(F.col("_lo"), F.col("_hi"))).select(*KEY)
    lost = stage(old_labels.join(looked, list(KEY), "left_semi").select(*KEY, "increment"), "lost")
    after = _replaced(old_labels, labels, lost, list(KEY), run.end, stage)
    _file(store, "labels", after, labels, lost, run.end)
    _file(store, "buckets", buckets, now, gone, run.end)

    ends = F.array(*[F.lit(e) for e in store.ends()])
    of = F.array_min(F.filter(ends, lambda e: e >= F.col(HEIGHT)))
    parts = stage(blocks.withColumn("increment", of), "blocks")
    touched = fresh.select(of.alias("increment")).unionByName(store.table("blocks").filter(within(dirty)).select("increment")).distinct()
    for part in sorted(r.increment for r in touched.collect()):
        store.keep("blocks", part, parts.filter(F.col("increment") == part).drop("increment"))

    # The state; rows of open buckets are those of the regions without a full one.
    changed = hull.select(OPERATOR)
    reopened = found.filter("_full is null and new_block >= 0").join(moved, OPERATOR, "left_anti").select(OPERATOR, "new_block")
    opened = rows.join(reopened, [OPERATOR, "new_block"], "left_semi").drop("new_block").unionByName(anew.open_rows)
    replaced_open = reopened.select(OPERATOR).unionByName(moved.select(OPERATOR)).distinct()
    kept = run.state["open"].join(replaced_open, OPERATOR, "left_anti").unionByName(opened)
    counts = buckets.groupBy(OPERATOR).agg(F.count("*").alias("_now"))
    pending = run.state["pending"].join(changed, OPERATOR, "left_anti").unionByName(
        waiting(buckets.drop("increment").join(changed, OPERATOR, "left_semi"), params))
    top = {"top": run.state["top"]} if "top" in run.state else {}
    store.keep_state({
        "validators": validators.join(counts, OPERATOR, "left").select(
            OPERATOR, "rows_before", "warm_from", F.coalesce("_now", F.lit(0)).alias("closed")
        ).filter("rows_before > 0 or warm_from is not null"),
        "open": kept, "pending": pending, **top,
    }, run.end)


def _replaced(old: DataFrame, now: DataFrame, gone: DataFrame, key: list[str], end: int, stage: Stage) -> DataFrame:
    """``old`` without ``gone`` and with ``now``, filed under the increment that held the key, or else the last."""
    held = gone.select(*key, "increment")
    filed = now.join(held, key, "left").withColumn("increment", F.coalesce("increment", F.lit(end)))
    return stage(old.join(held.select(*key), key, "left_anti").unionByName(filed.select(*old.columns)), "table")


def _file(store: Store, name: str, table: DataFrame, now: DataFrame, gone: DataFrame, end: int) -> None:
    """Write the parts of ``table`` that lost or got rows."""
    touched = {r.increment for r in gone.select("increment").distinct().collect()} | ({end} if now.limit(1).count() else set())
    for part in sorted(touched):
        store.keep(name, part, table.filter(F.col("increment") == part).drop("increment"))
