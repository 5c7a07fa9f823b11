"""Arrow batches of one text column, cut into slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task turns into Python or numpy values at a time.
SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Sub-batches with about ``most`` bytes of text; a longer text comes alone and whole."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if row > start and held + size > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
