"""What Python tasks take and return."""

from __future__ import annotations

import ctypes
import functools
import time
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.types import DataType, StructField, StructType


def extended(schema: StructType, **fields: DataType) -> StructType:
    """A new schema: the fields of ``schema``, then ``fields``; all may be null."""
    every = [StructField(f.name, f.dataType) for f in schema.fields]
    return StructType([*every, *(StructField(name, kind) for name, kind in fields.items())])


def sorted_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal keys, where rows come sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[k].to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            key = tuple(c[begin] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _give_back() -> None:
    """Return freed memory to the machine; where the C library cannot, Arrow's alone."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], every: float = 1.0):
    """``run``, giving back the memory it has freed after each ``every`` seconds, and in the end.

    Spark keeps Python workers for later tasks. What one has freed would else stay with it, beside
    what the others use.
    """

    @functools.wraps(run)
    def tidied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = time.monotonic()
        for batch in run(batches):
            yield batch
            del batch
            if time.monotonic() - last > every:
                _give_back()
                last = time.monotonic()
        _give_back()

    return tidied
