"""Memory of Python workers: batches in small slices, and nothing kept from task to task."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

# Rows of a batch that are worked on at once.
SLICE = 256

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def frugal(run: Run) -> Run:
    """``run`` over slices of the batches, so that what it makes of one is small.

    Workers outlive their tasks and go from stage to stage. When a task ends,
    also by a failure, what the process has free goes back to the machine.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batch.slice(n, SLICE) for batch in batches for n in range(0, batch.num_rows, SLICE))
        finally:
            release()

    return task


def release() -> None:
    """Gives free memory of Arrow and of the C library back, where there is a way to."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
