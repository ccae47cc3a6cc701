"""Counts of a growing table from stored sketches, so that no increment reads the rows before it again.

A part holds, for each group of the increment's rows, their exact number, a HyperLogLog sketch for each column whose distinct values
are counted and a KLL sketch for each numeric column whose quantiles are asked for. Parts are merged by Spark's own sketch functions;
a part has one row for each group, some kilobytes long, whatever its number of rows. Partial sketches are made before the shuffle, so a group
that holds most rows costs one small row for each task.

A part is named by its increment: adding an increment again replaces its part, so a repeated or corrected increment counts once. Increments
may come in any order. As everywhere in a store, parts count from the moment its manifest names them.

Numbers of rows are exact. A distinct count is off by more than three times ``1.04 / sqrt(2 ** precision)`` of itself in about one case
of 400 (counts of some hundreds and less are nearly exact); the rank of a quantile by more than ``rank_error()`` in one of 100.
Nulls and NaN are no values. A group without any value has 0 distinct values and null quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stakescore.incremental.carried import Store


def _distinct(name: str) -> str:
    return f"distinct_{name}"


def _ranks(name: str) -> str:
    return f"ranks_{name}"


class Sketches:
    """The sketches of a table, in a store below ``path``. One writer at a time.

    ``distinct`` and ``numeric`` name columns, ``by`` the columns of the groups (none: the whole table). ``precision`` is the
    logarithm of the registers of a distinct count (4 to 21), ``k`` the width of a quantile sketch (8 to 65535).
    """

    def __init__(
        self, spark: SparkSession, path: str, distinct: Sequence[str] = (), numeric: Sequence[str] = (),
        by: Sequence[str] = (), precision: int = 12, k: int = 200,
    ):
        if not 4 <= precision <= 21 or not 8 <= k <= 65_535:
            raise ValueError("precision must be 4 to 21, k 8 to 65535")
        self.spark, self.store = spark, Store(spark, path)
        self.distinct, self.numeric, self.by = list(distinct), list(numeric), list(by)
        self.precision, self.k = precision, k

    def distinct_error(self) -> float:
        """The relative standard error of a distinct count."""
        return 1.04 / 2 ** (self.precision / 2)

    def rank_error(self) -> float:
        """The error of a quantile's rank at 99 % confidence, by the published fit for KLL sketches."""
        return 2.296 / self.k ** 0.9723

    def of(self, rows: DataFrame) -> DataFrame:
        """The sketches of ``rows``, one row a group (one row in all without ``by``)."""
        return rows.groupBy(*self.by).agg(
            F.count("*").alias("rows"),
            *[F.hll_sketch_agg(F.col(c), self.precision).alias(_distinct(c)) for c in self.distinct],
            *[F.kll_sketch_agg_double(F.col(c).cast("double"), self.k).alias(_ranks(c)) for c in self.numeric],
        )

    def _keep(self, sketches: DataFrame, increment: int, replaced: Sequence[str] = ()) -> None:
        last = self.store.last()
        self.store.written = {}
        numbers = {"precision": F.lit(self.precision), "k": F.lit(self.k)}
        self.store.keep("sketches", increment, sketches.withColumns(numbers))
        self.store.keep_state({}, increment if last is None else max(last, increment), replaced)

    def add(self, rows: DataFrame, increment: int) -> None:
        """Note the rows of an increment, in place of those noted for it before; ``rows`` is read once."""
        if self.store.last() is not None:
            self._check()
        self._keep(self.of(rows), increment)

    def compact(self) -> None:
        """Write all sketches as one part that replaces the others, filed under the last increment, which cannot be repeated
        alone any more; nor can those before it.
        """
        if self.store.last() is not None:
            self._keep(self.merged(), self.store.last(), replaced=("sketches",))

    def _check(self) -> None:
        """The columns and numbers a store was written with are those it is read with."""
        table = self.store.table("sketches")
        expected = [*self.by, "rows", *map(_distinct, self.distinct), *map(_ranks, self.numeric), "precision", "k", "increment"]
        if table.columns != expected:
            raise ValueError(f"the store has columns {table.columns}, not {expected}")
        known = table.select("precision", "k").first()
        if known and tuple(known) != (self.precision, self.k):
            raise ValueError(f"the store has precision and k {tuple(known)}, not {(self.precision, self.k)}")

    def merged(self) -> DataFrame:
        """One row a group with the sketches of all increments."""
        if self.store.last() is None:
            raise ValueError("no increment was noted yet")
        self._check()
        return self.store.table("sketches").groupBy(*self.by).agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            *[F.hll_union_agg(F.col(_distinct(c))).alias(_distinct(c)) for c in self.distinct],
            *[F.kll_merge_agg_double(F.col(_ranks(c)), self.k).alias(_ranks(c)) for c in self.numeric],
        )

    def counts(self) -> DataFrame:
        """(by..., rows, one estimate of distinct values for each column of ``distinct``)."""
        return self.merged().select(
            *self.by, "rows", *[F.hll_sketch_estimate(F.col(_distinct(c))).alias(c) for c in self.distinct])

    def _sketch(self, column: str) -> Column:
        """A column's merged sketch, null where it holds no value: one without any cannot be asked."""
        if column not in self.numeric:
            raise ValueError(f"no quantiles of {column} are kept, only of {self.numeric}")
        kept = F.col(_ranks(column))
        return F.when(F.kll_sketch_get_n_double(kept) > 0, kept)

    def quantiles(self, column: str, fractions: Sequence[float]) -> DataFrame:
        """(by..., fraction, value): the values of about these ranks."""
        at = F.array(*[F.lit(float(f)) for f in fractions])
        found = self.merged().withColumn("_values", F.kll_sketch_get_quantile_double(self._sketch(column), at))
        each = F.arrays_zip(at.alias("fraction"), F.coalesce("_values", F.transform(at, lambda _: F.lit(None).cast("double"))).alias("value"))
        return found.select(*self.by, F.inline(each).alias("fraction", "value"))

    def histogram(self, column: str, edges: Sequence[float]) -> DataFrame:
        """(by..., low, high, rows): about how many values lie above ``low`` and not above ``high``, for ascending ``edges`` and,
        as nulls, without an end. A group's rows add up to its number of values.
        """
        if not edges or list(edges) != sorted(set(edges)):
            raise ValueError("edges must ascend")
        at = F.array(*[F.lit(float(e)) for e in edges])
        kept = self._sketch(column)
        values = F.coalesce(F.kll_sketch_get_n_double(kept), F.lit(0))
        below = F.coalesce(F.kll_sketch_get_rank_double(kept, at), F.array_repeat(F.lit(0.0), len(edges)))
        upto = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(below, lambda r: F.round(r * values).cast("bigint")), F.array(values))
        none = F.array(F.lit(None).cast("double"))
        rows = F.zip_with(F.slice("_upto", 2, len(edges) + 1), F.slice("_upto", 1, len(edges) + 1), lambda high, low: high - low)
        cells = F.arrays_zip(F.concat(none, at).alias("low"), F.concat(at, none).alias("high"), rows.alias("rows"))
        return self.merged().withColumn("_upto", upto).select(*self.by, F.inline(cells).alias("low", "high", "rows"))
