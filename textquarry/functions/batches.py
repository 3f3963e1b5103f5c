"""String columns of Arrow batches as bytes and offsets, and normalising in whole runs of them."""

from __future__ import annotations

import ctypes
import ctypes.util
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

try:
    _trim = ctypes.CDLL(ctypes.util.find_library("c") or "libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library
    _trim = None

#: Texts are handled in runs of about so many bytes.
RUN_BYTES = 1 << 20

_SIGN, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_SIGN[[ord(c) for c in string.punctuation]] = True
_BLANK[[*range(9, 14), *range(0x1C, 0x21)]] = True


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column without nulls, and its n+1 offsets."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * kind().itemsize).astype(np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def runs(offsets: np.ndarray, size: int | None = None) -> Iterator[tuple[int, int]]:
    """First and last row of runs of about ``size`` bytes, RUN_BYTES as a rule."""
    size = size or RUN_BYTES
    at, n = 0, len(offsets) - 1
    while at < n:
        end = min(n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1))
        yield at, end
        at = end


def filled(column: pa.Array) -> pa.Array:
    return column.fill_null("") if column.null_count else column


def release() -> None:
    """Give memory back to the system after a batch: a reused worker else keeps what its largest batches took."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def kept(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def unsigned(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts without ASCII punctuation."""
    return kept(data, offsets, ~_SIGN[data])


def blanks(data: np.ndarray) -> np.ndarray:
    """Which bytes are white space, those of longer characters included."""
    out = _BLANK[data]
    two = np.flatnonzero(data == 0xC2)
    two = two[np.isin(data[two + 1], (0x85, 0xA0))]
    out[two] = out[two + 1] = True
    three = np.flatnonzero((data >= 0xE1) & (data <= 0xE3))
    if len(three):
        code = (data[three].astype(np.int32) << 16) | (data[three + 1].astype(np.int32) << 8) | data[three + 2]
        hit = (code == 0xE19A80) | ((code >= 0xE28080) & (code <= 0xE2808A)) | np.isin(code, (0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080))
        three = three[hit]
        out[three] = out[three + 1] = out[three + 2] = True
    return out


def squeezed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with one space for each run of white space, none at either end."""
    blank = blanks(data)
    if not blank.any():
        return data, offsets
    head = blank.copy()
    head[1:] &= ~blank[:-1]
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    first, last = offsets[full], offsets[full + 1] - 1
    head[first] = blank[first]  # runs end with their text
    starts = np.flatnonzero(head)
    out = data.copy()
    out[starts] = 32
    keep = ~blank
    keep[starts] = True
    keep[first[blank[first]]] = False
    tail = last[blank[last]]
    keep[starts[np.searchsorted(starts, tail, "right") - 1]] = False
    return kept(out, offsets, keep)


def tidied(column: pa.Array) -> pa.Array:
    """Lower-cased texts without ASCII punctuation, with single spaces, decomposed; null for null."""
    data, offsets = bytes_of(filled(column))
    parts = []
    for a, b in runs(offsets):
        x, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        x, own = squeezed(*unsigned(x, own))
        part = pa.StringArray.from_buffers(b - a, pa.py_buffer(own.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x)))
        wide = pc.invert(pc.string_is_ascii(part))
        if wide.true_count:
            part = pc.replace_with_mask(part, wide, pc.utf8_normalize(part.filter(wide), form="NFD"))
        parts.append(part)
    out = pa.concat_arrays(parts) if parts else pa.array([], pa.string())
    return pc.if_else(column.is_valid(), out, pa.scalar(None, pa.string())) if column.null_count else out
