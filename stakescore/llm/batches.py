"""Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa


def batches_of(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
