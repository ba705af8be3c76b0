"""Texts of an Arrow batch as one block of bytes, for work with numpy inside tasks."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken in runs of about so many bytes, so that temporary arrays stay small.
RUN_BYTES = 2 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): text i is bytes[offsets[i]:offsets[i + 1]]; a null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """(first, last) text numbers, last exclusive, of runs of about ``limit`` bytes; a longer text is a run of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def windows(offsets: np.ndarray, width: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, text number) of windows that cover every byte of every text."""
    size = np.diff(offsets)
    count = np.where(size > width, -(-(size - width) // stride) + 1, (size > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][owner] + number * stride
    return start, np.minimum(width, offsets[1:][owner] - start), owner


def give_back() -> None:
    """Memory that Arrow and C no longer use goes back to the system: a Python worker outlives its tasks, and others run beside it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries have none
    if trim is not None:
        trim(0)


def begin_task() -> None:
    """To be called where a task begins that does not tokenize: drops the vocabulary and the cache that ``packing`` keeps in its workers."""
    packing = sys.modules.get("navspark.llm.packing")
    if packing is not None:
        packing.encoder.cache_clear()
    give_back()
