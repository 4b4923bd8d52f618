"""Texts of Arrow batches in parts of bounded bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PART_BYTES = 4 << 20


def parts(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices whose texts hold about ``limit`` bytes together; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total, start = 0, 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                total, start = 0, i
            total += int(size)
        if batch.num_rows > start:
            yield batch.slice(start)


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; NULL counts as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
