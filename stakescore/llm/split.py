"""Which rows a model may learn from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stakescore import staging

#: Values of the hash that picks samples.
SPAN = 1 << 31


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the ids whose CRC-32, as text, is divisible by five; false for null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def sampled(rows: DataFrame, group: str, doc_id: str, most: int) -> DataFrame:
    """About ``most`` rows of each group (all, if it has no more), once each: those whose ids have the smallest hashes.

    The number of a group's rows gives the share of the hashes to take from it; nothing is sorted. The counts are staged,
    so that Spark knows whether they are few enough to be broadcast to the rows. ``rows`` should be narrow.
    """
    named = rows.withColumn("_null", F.col(group).isNull()).withColumn("_group", F.coalesce(F.col(group).cast("string"), F.lit("")))
    counts = staging.written(named.groupBy("_null", "_group").agg(F.count("*").alias("_count")), "counts")
    hashed = F.pmod(F.xxhash64(doc_id), F.lit(SPAN))
    share = F.lit(float(most)) * SPAN / F.col("_count")
    return named.join(counts, ["_null", "_group"]).filter(hashed < share).select(*rows.columns).distinct()
