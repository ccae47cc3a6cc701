"""Exact deduplication with a persistent index of text digests.

The index is a table of (digest, keep_id), bucketed and sorted by digest, with one row for each text seen.
New data is aggregated by digest, keeps what a sort-merge anti-join does not find in the index (which is
read in its buckets, without a shuffle) and is appended in the same buckets. So the cost of new data does
not depend on how often a text repeats in it, and old data is never compared again.

The index keeps the row that came first; within one load, that of the largest id. Texts are equal if their
UTF-8 bytes are, as SHA-256 tells; a null text is an empty one. Null ids: a group without any other id
keeps null. Rows that repeat both id and text stay or go together. Other columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from stakescore import staging

BUCKETS = 64


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest): the SHA-256 of each whole text."""
    return docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("digest"),
    )


class DigestIndex:
    """The index below ``path``, which outlives the session: opened again, it goes on where it was."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        """All rows, as plain files, so that a join with a skewed side can be split."""
        return self.spark.read.schema("digest binary, keep_id long").parquet(self.path)

    def add(self, new: DataFrame) -> None:
        """Append the digests of ``new`` (doc_id, digest) that the index lacks."""
        first = new.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        known = self.spark.table(self.table).select("digest").hint("merge")
        fresh = first.join(known, "digest", "left_anti")
        # Dealt by Spark's own number of the bucket, a bucket is one file of one task, whatever the number of partitions.
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        (
            fresh.repartition(self.buckets, bucket).write.format("parquet").mode("append")
            .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.table)
        )

    def members(self, rows: DataFrame) -> DataFrame:
        """Per row of ``rows`` (doc_id, digest): keep_id, group_size, kept and text_sha256."""
        sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
        groups = self.rows().join(sizes, "digest")
        return rows.join(groups, "digest").select(
            "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )


def exact_duplicates(docs: DataFrame, index: DigestIndex, loads: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Load all documents and tell which stay: of equal texts, the row of the largest doc_id.

    The documents come in ``loads`` parts by falling doc_id, each against the index that the parts before
    have left; null ids come last.
    """
    rows = staging.written(digests(docs, doc_id, text), "digests")
    shares = [i / loads for i in range(1, loads)]
    cuts = (rows.agg(F.percentile_approx("doc_id", shares)).first()[0] or []) if shares else []
    bounds = [None, *sorted(set(cuts)), None]
    spans = list(zip(bounds[:-1], bounds[1:]))[::-1]
    for low, high in spans:
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col("doc_id") >= low)
        if high is not None:
            inside = inside & (F.col("doc_id") < high)
        if low is None:
            inside = inside | F.col("doc_id").isNull()
        index.add(rows.filter(inside))
    return index.members(rows)
