"""Arrow batches in pieces of bounded size, and memory given back after a task."""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def pieces_of(batch: pa.RecordBatch, column: str, n_bytes: int):
    """The batch in runs of rows of about ``n_bytes`` in a text or binary
    column; a row that is larger alone is a piece of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(batch):
        done = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + n_bytes, "right")))
        yield batch.slice(first, last - first)
        first = last


def give_back() -> None:
    """Return what is free in this process to the system.  An executor's Python
    workers live on after their task, beside stages that need the memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def then_give_back(function):
    """A ``mapInArrow`` function that gives memory back at the end of its task."""
    @functools.wraps(function)
    def run(batches):
        try:
            yield from function(batches)
        finally:
            give_back()
    return run
