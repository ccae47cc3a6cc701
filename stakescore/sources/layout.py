"""A panel stored the way its windows read it.

The rows are bucketed by validator and chunk of heights and sorted by height, so a window over (validator, chunk) needs no
shuffle, a validator with much of the table is spread over many buckets, and a range of heights skips row groups. Rows in the last
``halo`` heights of a chunk are stored in the next chunk too, marked as not at home there: a trailing window of at most ``halo + 1``
heights then lies within one chunk. The copies add ``halo / chunk`` to the table.

Below the folder are ``rows``, the bucketed files, and ``layout``, the numbers they were written with.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from stakescore.operators.chunked import Layout
from stakescore.schemas import HEIGHT, OPERATOR, PANEL_SCHEMA, project

BUCKETS = 64
#: Rows of a load that one task sorts and writes, and of a table that one bucket should hold.
ROWS_PER_TASK = ROWS_PER_BUCKET = 1_000_000


def buckets_for(rows: int, least: int = BUCKETS) -> int:
    """Buckets of a panel of so many rows: a window over (validator, chunk) sorts a bucket in one task."""
    return max(least, -(-rows // ROWS_PER_BUCKET))


@dataclass(frozen=True)
class StoredPanel:
    """A bucketed panel below ``path``; every session names its table anew."""

    spark: SparkSession
    path: str
    layout: Layout
    buckets: int
    table: str

    @classmethod
    def create(cls, spark: SparkSession, path: str, layout: Layout, buckets: int = BUCKETS) -> StoredPanel:
        """An empty panel in a new folder."""
        if buckets < 1:
            raise ValueError("buckets must be positive")
        numbers = asdict(layout) | {"buckets": buckets}
        path = path.rstrip("/")
        spark.range(1).select(*[F.lit(v).alias(k) for k, v in numbers.items()]).coalesce(1).write.json(f"{path}/layout")
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> StoredPanel:
        """The panel below ``path``, in the layout it was written with."""
        path = path.rstrip("/")
        numbers = spark.read.schema("chunk long, halo long, buckets int").json(f"{path}/layout").first()
        layout = Layout(numbers.chunk, numbers.halo)
        table = f"stored_panel_{uuid.uuid4().hex}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PANEL_SCHEMA)
        spark.sql(
            f"CREATE TABLE {table} ({columns}, {layout.CHUNK} BIGINT, {layout.HOME} BOOLEAN) USING parquet "
            f"CLUSTERED BY ({OPERATOR}, {layout.CHUNK}) SORTED BY ({OPERATOR}, {layout.CHUNK}, {HEIGHT}) "
            f"INTO {numbers.buckets} BUCKETS LOCATION '{path}/rows'"
        )
        return cls(spark, path, layout, numbers.buckets, table)

    def append(self, panel: DataFrame) -> None:
        """Add rows, of any heights: each one knows by itself the chunks it belongs to. ``panel`` is read twice, once to count
        its rows: pass a table. The tasks of a load go with its rows, whatever the number of buckets.
        """
        placed = self.layout.place(project(panel, PANEL_SCHEMA))
        # Tasks in a multiple of the buckets: as both go by the same hash, a task has rows of one bucket and writes one file.
        tasks = self.buckets * -(-panel.count() // (self.buckets * ROWS_PER_TASK)) or self.buckets
        (
            placed.repartition(tasks, OPERATOR, self.layout.CHUNK).write.format("parquet").mode("append")
            .bucketBy(self.buckets, OPERATOR, self.layout.CHUNK).sortBy(OPERATOR, self.layout.CHUNK, HEIGHT)
            .option("path", f"{self.path}/rows").saveAsTable(self.table)
        )

    def placed(self) -> DataFrame:
        """All stored rows with their chunk, copies among them, for windows that take a ``layout``."""
        return self.spark.table(self.table)

    def rows(self) -> DataFrame:
        """The panel: every row once."""
        return self.layout.at_home(self.placed())
