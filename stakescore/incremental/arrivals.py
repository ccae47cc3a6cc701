"""A panel that arrives as files: each run takes what is new and brings the labels up to date, then ends.

A file stream with an available-now trigger and a checkpoint finds the files that no run has taken yet. It reads their keys alone, and
notes for each file its lowest and highest height. Each of its batches is then one step of a :mod:`carried` store:

1. rows at heights that are done already came late: :mod:`corrections` puts right what depends on them;
2. all heights but the newest ``lag`` ones become an increment, which reads the files that reach into its activity window.

What a batch began with is written down before it changes the store, so a run that was killed anywhere is repeated by running it
again: the stream gives the same batch, a correction that is done is not made twice, nor is an increment. All that
belongs to the store lies in its folder, checkpoint and notes of files included. One run at a time.

A file must appear whole and stay as it is; rows are added by files, never changed (for that use :func:`corrections.correct`). Copies of a key
are an error, as in any run. Rows without a height are no rows.
"""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from stakescore.incremental import carried, corrections
from stakescore.incremental.carried import MANIFEST, Store
from stakescore.operators.chunked import CHUNK
from stakescore.params import ScoringParams
from stakescore.schemas import HEIGHT, KEY, PANEL_SCHEMA
from stakescore.staging import Stage, written

FILES_SCHEMA = "file string, lo int, hi int"


class Arrivals:
    """Labels of a panel whose Parquet files arrive in the folder ``source``.

    ``top`` (``operator_address``) is kept by the first increment; without it the survey's top set is, and batches before the
    survey's end wait. ``lag`` heights at the top are held back, as files to come may add rows to them. A batch has at most
    ``files_each`` files.
    """

    def __init__(
        self, spark: SparkSession, source: str, path: str, params: ScoringParams, top: DataFrame | None = None,
        lag: int = 1, files_each: int = 1_000, stage: Stage = written, chunk: int = CHUNK,
    ):
        if lag < 0 or files_each < 1:
            raise ValueError("lag must not be negative, files_each must be positive")
        self.spark, self.source, self.path = spark, source, path.rstrip("/")
        self.store, self.params, self.top = Store(spark, path), params, top
        self.lag, self.files_each, self.stage, self.chunk = lag, files_each, stage, chunk

    def run(self) -> None:
        """Take all files that are there now, in batches, and end."""
        keys = (
            self.spark.readStream.schema(PANEL_SCHEMA).option("maxFilesPerTrigger", self.files_each).parquet(self.source)
            .select(*KEY, F.col("_metadata.file_path").alias("file"))
        )
        query = (
            keys.writeStream.foreachBatch(self._step).option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()

    def finish(self) -> None:
        """Label the heights held back too, and short last buckets; nothing can follow."""
        hi = self._files().agg(F.max("hi")).first()[0]
        if hi is not None and (self.store.last() is None or hi > self.store.last()):
            carried.advance(self._panel(self._low()), self.store, hi, self.params, self.top, True, self.stage, self.chunk)

    def labels(self) -> DataFrame:
        return self.store.labels()

    def _step(self, keys: DataFrame, batch: int) -> None:
        """One batch of the stream."""
        heights = keys.filter(F.col(HEIGHT).isNotNull()).groupBy("file").agg(F.min(HEIGHT).alias("lo"), F.max(HEIGHT).alias("hi"))
        heights.write.mode("overwrite").parquet(f"{self.path}/files/batch={batch}")
        begun = self._begun(batch)
        after = begun["after"]
        if after is not None:
            late = self._files().filter((F.col("batch") == batch) & (F.col("lo") <= after))
            if begun["states"] == self._states() and late.limit(1).count():
                rows = self._read(late).filter(F.col(HEIGHT) <= after).select(*KEY, F.lit(1).alias("delta"))
                corrections.correct(self._panel(), self.store, rows, self.params, self.stage, self.chunk)
        end = self._end()
        if end is not None:
            carried.advance(self._panel(self._low()), self.store, end, self.params, self.top, stage=self.stage, chunk=self.chunk)

    def _states(self) -> int:
        return len(self.store._manifests())

    def _begun(self, batch: int) -> dict:
        """The last height done and the number of states when the batch was first tried."""
        folder = f"{self.path}/batches/{batch}"
        fs, where = self.store._fs(f"{folder}/{MANIFEST}")
        if not fs.exists(where):
            self.store.commit(folder, {"after": self.store.last(), "states": self._states()})
        return json.loads(self.spark.read.text(f"{folder}/{MANIFEST}", wholetext=True).first()[0])

    def _files(self) -> DataFrame:
        """(file, lo, hi, batch): the files taken."""
        fs, where = self.store._fs(f"{self.path}/files")
        if not fs.exists(where):
            return self.spark.createDataFrame([], f"{FILES_SCHEMA}, batch int")
        return self.spark.read.schema(f"{FILES_SCHEMA}, batch int").parquet(f"{self.path}/files")

    def _read(self, files: DataFrame) -> DataFrame:
        """The rows of some files; their names, as with any file source, are on the driver."""
        names = [unquote(r.file) for r in files.select("file").collect()]
        if not names:
            return self.spark.createDataFrame([], PANEL_SCHEMA)
        return self.spark.read.schema(PANEL_SCHEMA).parquet(*names).filter(F.col(HEIGHT).isNotNull())

    def _low(self) -> int | None:
        """The lowest height that the next increment reads."""
        done = self.store.last()
        return None if done is None else done - self.params.vote_proposed_win_size + 2

    def _panel(self, low: int | None = None) -> DataFrame:
        """The panel as the files taken hold it, of those alone that reach up to ``low``."""
        files = self._files()
        return self._read(files if low is None else files.filter(F.col("hi") >= low))

    def _end(self) -> int | None:
        """The last height of the next increment, one that there is; nothing if there is none yet."""
        files, done = self._files(), self.store.last()
        hi = files.agg(F.max("hi")).first()[0]
        if hi is None:
            return None
        ready = F.col(HEIGHT) <= hi - self.lag
        if done is not None:
            files, ready = files.filter(F.col("hi") > done), ready & (F.col(HEIGHT) > done)
        end = self._read(files).filter(ready).agg(F.max(HEIGHT)).first()[0]
        waits = done is None and self.top is None and self.params.top_validators is not None
        return None if end is None or (waits and end < self.params.end_block) else end
