"""Increments that carry their state, and replace their own part when they run again.

A store is a folder with these tables:

- ``labels`` (the label table), ``buckets`` (all full buckets of the validators kept, with their number) and ``blocks`` (the values
  of every block), each with a part for each increment, named by its last height, that the increment writes as a whole;
- ``state``, one for each increment or correction: of all validators the rows below the next increment's first height, the height
  at which they warmed up and their number of full buckets; the rows of open buckets; the buckets that wait for a label; the top set.

An increment reads the panel from one activity window before its first height on, for every use; all that depends on older heights is in the state,
whose size goes with the number of validators and the label window, not with the history. A state has a manifest of the parts
that belong to it, which appears at once and last: an increment that was killed before is repeated by running it again, whatever it
had written (parts that no manifest names are not read), and one that is done does nothing. One writer at a time.

All increments together give the labels of one run over the whole history, whatever heights the validators miss.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from stakescore.operators import labeling
from stakescore.operators.chunked import CHUNK, forward_mean
from stakescore.operators.quality import height_bounds
from stakescore.params import ScoringParams
from stakescore.plans import data_scoring as plans
from stakescore.schemas import BLOCK_LABEL_SCHEMA, HEIGHT, OPERATOR, PANEL_COLUMNS, project
from stakescore.staging import Stage, written

#: The file that names a state's tables and the parts of the others.
MANIFEST = "manifest.json"


class Store:
    """A folder of tables that increments extend."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.written: dict[str, dict[str, str]] = {}

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _manifests(self) -> list[str]:
        """The states that are whole, in order."""
        fs, where = self._fs(f"{self.path}/state")
        folders = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        return [f"{self.path}/state/{f}" for f in sorted(folders) if fs.exists(self._fs(f"{self.path}/state/{f}/{MANIFEST}")[1])]

    def _manifest(self) -> dict:
        done = self._manifests()
        if not done:
            return {"end": None, "parts": {}, "tables": []}
        return json.loads(self.spark.read.text(f"{done[-1]}/{MANIFEST}", wholetext=True).first()[0])

    def last(self) -> int | None:
        """The last height of the increments that are done."""
        return self._manifest()["end"]

    def state(self) -> dict[str, DataFrame] | None:
        """The last state that is whole; ``top`` is missing where all validators are kept."""
        done = self._manifests()
        return {name: self.spark.read.parquet(f"{done[-1]}/{name}") for name in self._manifest()["tables"]} if done else None

    def keep(self, name: str, increment: int, frame: DataFrame) -> DataFrame:
        """Write ``frame`` as the whole part of ``increment`` in a table; it counts from the next state on."""
        folder = f"{self.path}/{name}/{increment}-{uuid.uuid4().hex}"
        frame.withColumn("increment", F.lit(increment)).write.parquet(folder)
        self.written.setdefault(name, {})[str(increment)] = folder
        return self.spark.read.parquet(folder).drop("increment")

    def keep_state(self, frames: dict[str, DataFrame], end: int, replaced: Sequence[str] = ()) -> None:
        """Write the state and then, at once, name it and all parts of tables that belong to it. Of the tables in ``replaced``
        only the parts written now belong to it.
        """
        done = self._manifests()
        folder = f"{self.path}/state/{len(done):08d}"
        for name, frame in frames.items():
            frame.write.mode("overwrite").parquet(f"{folder}/{name}")
        parts = self._manifest()["parts"]
        for name, new in self.written.items():
            parts[name] = ({} if name in replaced else parts.get(name, {})) | new
        self.commit(folder, {"end": end, "parts": parts, "tables": list(frames)})
        self.written = {}

    def commit(self, folder: str, manifest: dict) -> None:
        fs, draft = self._fs(f"{folder}/_{MANIFEST}")
        out = fs.create(draft, True)
        out.write(json.dumps(manifest).encode())
        out.close()
        fs.rename(draft, self._fs(f"{folder}/{MANIFEST}")[1])

    def ends(self) -> list[int]:
        """The last heights of all increments that are done."""
        return sorted(map(int, self._manifest()["parts"].get("labels", {})))

    def table(self, name: str) -> DataFrame:
        """All parts of a table by increments that are done, with the column ``increment``."""
        return self.spark.read.parquet(*self._manifest()["parts"][name].values())

    def labels(self) -> DataFrame:
        """The label table."""
        if self.last() is None:
            return self.spark.createDataFrame([], BLOCK_LABEL_SCHEMA)
        return project(self.table("labels"), BLOCK_LABEL_SCHEMA)


@dataclass(frozen=True)
class Buckets:
    """Rows put into buckets: the full ones, numbered on from the validator's last, and the rows of the others."""

    full: DataFrame
    open_rows: DataFrame


def bucketed(rows: DataFrame, closed: DataFrame, params: ScoringParams, stage: Stage, chunk: int, last: bool = False) -> Buckets:
    """``rows`` begin at the first row of a bucket for each validator; ``closed`` (operator_address, closed) numbers it."""
    size = params.combine_win_size
    local = labeling.combine_data(rows, size, chunk=chunk, rows="_rows").join(closed, OPERATOR, "left")
    found = stage(local.withColumn("new_block", F.col("new_block") + F.coalesce("closed", F.lit(0))).drop("closed"), "buckets")
    whole = F.lit(True) if last else F.col("_rows") == size
    begun = found.filter(~whole).select(OPERATOR, F.col(HEIGHT).alias("_begin"))  # one for each validator at most
    return Buckets(found.filter(whole).drop("_rows"), rows.join(begun, OPERATOR).filter(F.col(HEIGHT) >= F.col("_begin")).drop("_begin"))


def waiting(buckets: DataFrame, params: ScoringParams) -> DataFrame:
    """The buckets whose label looks at one that is not there yet."""
    ahead = params.label_win_size // params.combine_win_size
    last = buckets.groupBy(OPERATOR).agg(F.max("new_block").alias("_last"))
    return buckets.join(last, OPERATOR).filter(F.col("new_block") + ahead > F.col("_last")).drop("_last")


def labelled(buckets: DataFrame, params: ScoringParams) -> DataFrame:
    """The ``block_label`` rows of buckets whose label window is there and that have no null, with their number."""
    ahead = params.label_win_size // params.combine_win_size
    found = forward_mean(buckets, "score", ahead, [OPERATOR], "new_block", "label").na.drop()
    return project(found, BLOCK_LABEL_SCHEMA)


def advance(
    panel: DataFrame, store: Store, end_block: int, params: ScoringParams, top: DataFrame | None = None,
    last: bool = False, stage: Stage = written, chunk: int = CHUNK,
) -> None:
    """One increment: all heights after the last one's up to ``end_block``. Nothing if they are done already.

    ``top`` (``operator_address``) is kept in the state by the first increment; without it the survey's top set is,
    so the first must reach the survey's end. ``last`` labels short last buckets as well; no increment can follow it.
    """
    store.written = {}
    done, state = store.last(), store.state()
    if done is not None and done >= end_block:
        return
    low = None if done is None else done - params.vote_proposed_win_size + 2
    fresh = F.lit(True) if done is None else F.col(HEIGHT) > done
    recent = panel.filter(F.col(HEIGHT) <= end_block)
    if low is not None:
        recent = recent.filter(F.col(HEIGHT) >= low)
    bounds = height_bounds(recent).first()
    if bounds.max_height is None or bounds.max_height < end_block:
        raise ValueError(f"end block {end_block} is beyond the source's last block {bounds.max_height}")
    if state is None and top is None and params.top_validators is not None:
        top = plans.survey(panel.filter(F.col(HEIGHT) <= end_block), params, stage, chunk)
    if state is not None:
        top = state.get("top")
    elif top is not None:
        top = stage(top.select(OPERATOR), "top")

    older = None if state is None else state["validators"].select(OPERATOR, "rows_before")
    everyone = stage(plans.activity_once(recent, params, (), chunk, older), "activity")
    warm = plans.eligible(params) & fresh
    blocks = store.keep("blocks", end_block, plans.block_values(
        plans.total_values(recent.filter(fresh)), plans.largest_activity(everyone.filter(warm)), params))
    # Their rows are written once: all uses of them together would read the panel as often.
    own = recent if top is None else stage(labeling.keep_validators(recent.select(*PANEL_COLUMNS), top, top.count()), "own")
    rows = plans.scored_rows(plans.activity_once(own, params, chunk=chunk, rows_before=older).filter(warm), blocks, params)
    closed = everyone.limit(0).select(OPERATOR, F.lit(0).cast("bigint").alias("closed"))
    if state is not None:
        rows = rows.unionByName(state["open"])
        closed = state["validators"].select(OPERATOR, "closed")
    found = bucketed(stage(rows, "scored"), closed, params, stage, chunk, last)
    buckets = found.full if state is None else stage(found.full.unionByName(state["pending"]), "buckets")

    store.keep("buckets", end_block, found.full)
    store.keep("labels", end_block, labelled(buckets, params))
    store.keep_state({
        "validators": _validators(everyone, state, found.full, end_block - params.vote_proposed_win_size + 2, params),
        "open": found.open_rows, "pending": waiting(buckets, params), **({} if top is None else {"top": top}),
    }, end_block)


def _validators(everyone: DataFrame, state: dict | None, full: DataFrame, next_low: int, params: ScoringParams) -> DataFrame:
    """(operator_address, rows_before, warm_from, closed) after an increment; a row for each validator ever met."""
    met = everyone.groupBy(OPERATOR).agg(
        F.count_if(F.col(HEIGHT) < next_low).alias("rows_before"),
        F.min(F.when(F.col("_position") == params.vote_proposed_win_size, F.col(HEIGHT))).alias("warm_from"),
    )
    added = full.groupBy(OPERATOR).agg(F.count("*").alias("closed"))
    now = met.join(added, OPERATOR, "left").withColumn("closed", F.coalesce("closed", F.lit(0)))
    if state is None:
        return now
    return now.unionByName(state["validators"]).groupBy(OPERATOR).agg(
        F.sum("rows_before").alias("rows_before"), F.min("warm_from").alias("warm_from"), F.sum("closed").alias("closed"))
