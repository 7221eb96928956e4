"""Arrow batches in parts of bounded size, as Spark bounds their rows and not their texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that Python works on at once.
PART_BYTES = 1 << 20


def in_parts(batches: Iterator[pa.RecordBatch], column: str, most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices in order, each with at most `most` bytes in the column or of one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
