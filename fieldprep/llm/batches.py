"""Small steps through the record batches that Spark hands to Python."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Rows turned into Python objects at once; a batch of Spark's may hold thousands of long texts.
ROWS = 256


def steps(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices, which share their memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()
