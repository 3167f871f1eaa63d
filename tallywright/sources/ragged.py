"""Rows of bytes of any length, one after the other in an array, handled for a whole batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute


def places(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Place of each byte of rows that start at `begin` and have these sizes."""
    return np.arange(int(sizes.sum())) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)


def rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column of strings, and where in them each row starts (and the last ends); a null has none."""
    column = pa.compute.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), starts


def strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Strings from their bytes, one after the other."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    found = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
    found.validate(full=True)
    return found
