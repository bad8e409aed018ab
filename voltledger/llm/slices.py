"""Slices of an Arrow column that hold a bounded number of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTES_AT_ONCE = 4 << 20


def by_bytes(column: pa.Array, limit: int = BYTES_AT_ONCE) -> Iterator[tuple[int, int]]:
    """(start, stop) of slices of about ``limit`` bytes; a longer value is a slice of its own."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start, done = 0, 0
    while start < len(column):
        stop = max(int(np.searchsorted(upto, done + limit, side="right")), start + 1)
        yield start, stop
        start, done = stop, int(upto[stop - 1])
