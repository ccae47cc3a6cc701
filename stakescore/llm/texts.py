"""Running a Python model over the texts of a table, with or without the table's other columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from stakescore.llm.batches import batches_of
from stakescore.llm.kept import released

#: Texts that are Python's at once.
AT_ONCE = 1024
#: Makes columns from texts.
Columns = Callable[[list], dict[str, pa.Array]]


def added(docs: DataFrame, doc_id: str, text: str, make: Callable[[], Columns], schema: str, carry: bool) -> DataFrame:
    """doc_id (long) and the columns that the model makes of each text; ``make`` runs once a task.

    With ``carry`` there is a column ``doc`` too, with the whole row under the names it had, which can't
    clash with the others. Each row stays where it lies.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), *[rest.alias("rest")] * carry)
    kept = ["doc_id", *["text", "rest"] * carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        columns = make()
        for batch in batches_of(batches, AT_ONCE):
            yield pa.record_batch({c: batch.column(c) for c in kept} | columns(batch.column("text").to_pylist()))

    made = StructType.fromDDL(schema)
    out = rows.mapInArrow(run, StructType([rows.schema[c] for c in kept] + made.fields))
    if not carry:
        return out
    whole = F.struct(*[(F.col("text") if c == text else F.col("rest")[c]).alias(c) for c in docs.columns])
    return out.select("doc_id", *made.names, whole.alias("doc"))
