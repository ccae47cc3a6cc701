"""Connected components of a graph given as edges between long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stakescore import staging


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each vertex to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each vertex and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(vertex, component): for each vertex that has a link, the smallest vertex it reaches.

    Alternating large-star and small-star rounds, each a table in the shared folder; a vertex of very many
    links is split by Spark's skew join, as its minimum is aggregated before the shuffle. Rounds end when
    the edges no longer change; only their count and checksum reach the driver. Edges from a vertex to
    itself, or with a null end, and repeated edges do no harm; no edges give no rows.
    """
    one, two = F.col(left).cast("bigint"), F.col(right).cast("bigint")
    edges = staging.written(
        edges.filter(one != two).select(F.greatest(one, two).alias("u"), F.least(one, two).alias("v")).distinct(), "edges"
    )
    before, now = None, _state(edges)
    while now != before:
        turned = staging.written(_large_star(edges).filter("u <> v").distinct(), "edges")
        turned = staging.written(_small_star(turned).filter("u <> v").distinct(), "edges")
        before, now = now, _state(turned)
        edges = turned
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    )
