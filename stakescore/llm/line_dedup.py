"""Boilerplate lines by their frequency within a site.

A line is boilerplate on a host if the host's pages that contain it are more than ``ratio`` of all its
pages, and at least ``min_pages``. Such lines are dropped from the host's pages; other hosts keep them.

DataFrame functions only. Every page counts a line once, lines are counted by (host, line) with partial
sums before the shuffle, and what is frequent enough is joined with the hosts' totals. Then the narrow rows
(page, place of the line) of frequent lines are gathered by page, and each page is cut where it lies or in a
join by its own key; a host or a line that a third of all pages share is never one task's group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stakescore import staging

RATIO = 0.05
MIN_PAGES = 3


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; null if it has none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _key(line: Column) -> list[Column]:
    """96 bits that stand for a line, without white space at its ends."""
    return [F.xxhash64(_trimmed(line)).alias("h1"), F.hash(_trimmed(line), F.lit(1)).alias("h2")]


def _pages(docs: DataFrame, host: str, doc_id: str, text: str) -> DataFrame:
    """Under names of their own, whatever the columns of ``docs`` are called."""
    return docs.select(
        F.struct("*").alias("doc"), F.col(doc_id).cast("bigint").alias("page"), F.col(host).alias("host"),
        F.col(text).alias("text"), F.xxhash64(host, text).alias("version"),
    )


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, copies: bool = True) -> DataFrame:
    """(host, h1, h2, pages, host_pages) of the lines to drop from ``pages`` (host, text, version).

    Without ``copies``, pages of a host with the same text count once, in a line's pages and in the host's.
    """
    count = F.count("*") if copies else F.count_distinct("version")
    sites = pages.filter("host is not null")
    lines = F.array_distinct(F.transform(F.split("text", "\n"), _trimmed))
    counted = sites.select("host", "version", F.explode(lines).alias("line")).filter("line <> ''").groupBy(
        "host", *_key(F.col("line"))
    ).agg(count.alias("pages"))
    totals = sites.groupBy("host").agg(count.alias("host_pages"))
    return counted.filter(F.col("pages") >= min_pages).join(totals, "host").filter(
        F.col("pages") > ratio * F.col("host_pages")
    )


def drop_boilerplate(
    docs: DataFrame, host: str, doc_id: str = "doc_id", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES,
    copies: bool = True,
) -> DataFrame:
    """``docs`` with the boilerplate lines cut out of ``text``, and the columns n_lines and n_dropped.

    A null text stays null, with no lines; blank lines stay; a null host is no site, and its pages stay as
    they are. Rows that repeat count as pages of their own; without ``copies``, the same text on a host counts
    once, so a text isn't boilerplate for having copies. A page of nothing but boilerplate becomes empty.
    Columns named n_lines and n_dropped are replaced, others are passed on whatever their names.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    pages = _pages(docs.select(*[F.col(f"`{c}`") for c in columns]), host, doc_id, text)
    frequent = staging.written(boilerplate(pages, ratio, min_pages, copies).select("host", "h1", "h2"), "boilerplate")
    places = pages.filter("host is not null").select(
        "page", "version", "host", F.posexplode(F.split("text", "\n")).alias("place", "line")
    ).filter(_trimmed(F.col("line")) != "").select("page", "version", "place", "host", *_key(F.col("line")))
    # As a set, since rows that repeat give each place more than once.
    cut = staging.written(
        places.join(frequent, ["host", "h1", "h2"], "left_semi").groupBy("page", "version").agg(F.collect_set("place").alias("cut")),
        "cut",
    ).withColumnsRenamed({"page": "cut_page", "version": "cut_version"})
    # Hashed by page at any size: the pages are shuffled once, and not sorted.
    joined = pages.join(
        cut.hint("shuffle_hash"), F.col("page").eqNullSafe(F.col("cut_page")) & (F.col("version") == F.col("cut_version")), "left"
    ).withColumn("lines", F.split("text", "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("cut"))
    without = F.array_join(F.transform(kept, lambda i: F.get(F.col("lines"), i)), "\n")
    rest = F.when(F.col("cut").isNull(), F.col("text")).otherwise(without)
    return joined.select(
        *[rest.alias(c) if c == text else F.col("doc")[c].alias(c) for c in columns],
        F.when(F.col("text").isNotNull(), F.size("lines")).otherwise(0).alias("n_lines"),
        F.coalesce(F.size("cut"), F.lit(0)).alias("n_dropped"),
    )
