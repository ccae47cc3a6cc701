"""JDBC table scan and append sink. Connection settings come from the caller."""

from __future__ import annotations

import bisect
from itertools import accumulate

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stakescore.schemas import HEIGHT

POSTGRES_DRIVER = "org.postgresql.Driver"
#: Fixed value: the types of the panel's amounts, which exceed 64 bits and are read whole.
AMOUNT_TYPES = "tokens decimal(38,0), delegator_shares decimal(38,0), self_bonded decimal(38,0)"


#: Connections of a parallel scan.
PARTITIONS = 16


def postgres_url(host: str, port: int, database: str) -> str:
    return f"jdbc:postgresql://{host}:{port}/{database}"


def scan_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str = POSTGRES_DRIVER,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = PARTITIONS,
    custom_schema: str | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of a scan. ``table`` may be a parenthesised query with an alias. With height bounds the scan
    runs as ``partitions`` parallel range queries (rows outside the bounds are read too); without them it is
    one query, for small tables and aggregates. ``custom_schema`` overrides the types that Spark derives.
    """
    options = {"url": url, "dbtable": table, "driver": driver}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if custom_schema is not None:
        options["customSchema"] = custom_schema
    if lower is not None and upper is not None:
        options |= {
            "partitionColumn": HEIGHT,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    elif lower is not None or upper is not None:
        raise ValueError("a parallel scan needs both height bounds")
    return options | {k: str(v) for k, v in extra.items()}


def query(spark: SparkSession, url: str, table: str, **settings) -> DataFrame:
    return spark.read.format("jdbc").options(**scan_options(url, table, **settings)).load()


def sampling(
    spark: SparkSession, url: str, table: str, from_block: int, to_block: int, partitions: int = PARTITIONS,
    custom_schema: str | None = AMOUNT_TYPES, **settings
) -> DataFrame:
    """The inclusive height range of a panel table, as parallel range queries; the database filters."""
    return query(
        spark, url, table, lower=from_block, upper=to_block + 1, partitions=partitions,
        custom_schema=custom_schema, **settings
    ).filter(F.col(HEIGHT).between(from_block, to_block))


#: Cells that a part's rows are counted in: the more, the closer the parts' sizes.
CELLS_EACH = 16
#: Into how many cells a heavy one is cut, as a power of two.
FINER = 6

#: Heights from the first on, and their number of rows.
Cell = tuple[int, int]


def histogram_query(table: str, first: int, width: int, spans: list[tuple[int, int]]) -> str:
    """Rows by cell of ``width`` heights, counted from ``first`` on, within inclusive spans of heights; as a table for a scan."""
    cell = f"CAST(floor(({HEIGHT} - {first}) / {width}) AS INTEGER)"
    inside = " OR ".join(f"{HEIGHT} BETWEEN {low} AND {high}" for low, high in spans)
    return f"(SELECT {cell} AS cell, count(*) AS height_rows FROM {table} WHERE {inside} GROUP BY {cell}) AS cells"


def height_cells(count: Callable[[int, list[tuple[int, int]]], list[Cell]], first: int, last: int, partitions: int) -> list[Cell]:
    """Cells of heights (first height, rows) from ``first`` to ``last``, none of which has much of a part's rows unless it is one height.

    ``count(width, spans)`` gives (cell, rows) as :func:`histogram_query` does. Cells of one width are counted first and heavy ones
    again in finer cells, so few rows come back whatever the table's size, and however uneven its heights are.
    """
    power = max(0, ((last - first) // (partitions * CELLS_EACH)).bit_length())
    spans, light = [(first, last)], []
    total = None
    while spans:
        width = 1 << power
        found = [(first + cell * width, rows) for cell, rows in count(width, spans)]
        total = sum(rows for _, rows in found) if total is None else total
        heavy = [low for low, rows in found if width > 1 and rows * CELLS_EACH * partitions > total * 2]
        light += [cell for cell in found if cell[0] not in set(heavy)]
        spans = [(low, min(last, low + width - 1)) for low in heavy]
        power = max(0, power - FINER)
    return sorted(light)


def even_bounds(cells: list[Cell], first: int, last: int, partitions: int) -> list[tuple[int, int]]:
    """Inclusive ranges of heights that cover ``first`` to ``last`` and hold about as many rows each, cut between cells."""
    until = list(accumulate(rows for _, rows in cells))
    total = until[-1] if until else 0
    cuts = set()
    for part in range(1, partitions):
        goal = total * part / partitions
        at = bisect.bisect_left(until, goal)
        if at < len(cells):  # the end of the cell that reaches the goal, or its begin, whichever is nearer
            before = until[at] - cells[at][1]
            cuts.add(at if goal - before < until[at] - goal else at + 1)
    begins = [first, *[cells[at][0] for at in sorted(cuts) if 0 < at < len(cells)]]
    return list(zip(begins, [begin - 1 for begin in begins[1:]] + [last]))


def range_predicates(bounds: list[tuple[int, int]]) -> list[str]:
    """One condition for each task of a scan."""
    return [f"{HEIGHT} >= {low} AND {HEIGHT} <= {high}" for low, high in bounds]


def even_sampling(
    spark: SparkSession, url: str, table: str, from_block: int, to_block: int, partitions: int = PARTITIONS,
    custom_schema: str | None = AMOUNT_TYPES, **settings
) -> DataFrame:
    """The inclusive height range of a panel table, as parallel range queries of about as many rows each, whatever heights are
    missing or crowded. The database counts rows by height range first. Rows of one height are read by one task.
    """
    def count(width: int, spans: list[tuple[int, int]]) -> list[Cell]:
        rows = query(spark, url, histogram_query(table, from_block, width, spans), **settings).collect()
        return [(r.cell, r.height_rows) for r in rows]

    cells = height_cells(count, from_block, to_block, partitions)
    predicates = range_predicates(even_bounds(cells, from_block, to_block, partitions))
    options = scan_options(url, table, custom_schema=custom_schema, **settings)
    del options["url"], options["dbtable"]
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def height_bounds(spark: SparkSession, url: str, table: str, **settings) -> DataFrame:
    """(min_height, max_height) of a table; the database aggregates."""
    bounds = f"(SELECT min({HEIGHT}) AS min_height, max({HEIGHT}) AS max_height FROM {table}) AS bounds"
    return query(spark, url, bounds, **settings)


def sink_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str = POSTGRES_DRIVER,
    batchsize: int = 1000,
    **extra: str,
) -> dict[str, str]:
    return scan_options(
        url, table, user, password, driver, batchsize=str(batchsize), **extra
    )


def upload(df: DataFrame, url: str, table: str, mode: str = "append", **settings) -> None:
    """Append to a table. Pass ``incremental.backfill.append_dedup`` output to make a re-run harmless."""
    df.write.format("jdbc").options(**sink_options(url, table, **settings)).mode(mode).save()
