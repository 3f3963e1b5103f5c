"""Arrow and numpy helpers of the text operators."""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

try:
    _trim = ctypes.CDLL(ctypes.util.find_library("c") or "libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library
    _trim = None

#: Texts are handled in runs of about this many bytes; one longer text makes a run of its own.
RUN_BYTES = 1 << 19


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n+1 offsets of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * kind().itemsize)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    start = int(offsets[0])
    return whole[start : int(offsets[-1])], offsets.astype(np.int64) - start


def runs(offsets: np.ndarray, size: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``size`` bytes."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(end, n)
        at = end


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on unsigned 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ragged(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List column from flat values and n+1 offsets."""
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(values, kind)).cast(pa.list_(kind))


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... of every run, one run after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def release() -> None:
    """Give memory back to the system after a batch: a reused worker else keeps what its largest batch took."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)
