"""Word-level view of texts for the matching operators.

A text becomes ``" w1 w2 ... wn \\n"``: lower case, every run of ASCII signs and white space one space, bytes beyond
ASCII kept as parts of words. Hashing works on these bytes with whole-array operations.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from textquarry.llm.arrays import mix64, text_bytes

FOLD = np.full(256, 32, np.uint8)
FOLD[48:58] = np.arange(48, 58)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)

#: The same folding as a regular expression for engines that have one: what becomes a space.
GAP_PATTERN = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def framed(text: str | Column = "text") -> Column:
    """Lower-cased text between the marks that ``fold`` expects; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" \n"))


def fold(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of framed texts and their n+1 offsets."""
    return fold_bytes(*text_bytes(column))


def fold_bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = FOLD[data]
    gap = x == 32
    keep = np.ones(len(x), bool)
    np.logical_not(gap[1:] & gap[:-1], out=keep[1:])
    ends = offsets[1:] - 1
    keep[ends] = True
    keep[offsets[:-1]] = True
    x[ends] = 10
    before = np.zeros(len(x) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    return x[keep], before[offsets]


def fold_text(text: str | None, lower: bool = True) -> bytes:
    """One folded text without its end mark."""
    text = text or ""
    words = bytes(FOLD[np.frombuffer((text.lower() if lower else text).encode(), np.uint8)]).split()
    return b" " + b"".join(w + b" " for w in words)


#: Longer words are hashed one by one.
_LONG_WORD = 64
_C = np.uint64(0x9E3779B97F4A7C15)
_LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words data[start:end]: eight bytes at a time, mixed in between, so that no algebra cancels."""
    size = end - start
    blocks = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), 0, (1,))
    out = mix64(mix64(size.astype(np.uint64)) ^ (blocks[start] & _LOW_BYTES[np.minimum(size, 8)]))
    more, k = np.flatnonzero((size > 8) & (size <= _LONG_WORD)), 8
    while len(more):
        rest = blocks[start[more] + k] & _LOW_BYTES[np.minimum(size[more] - k, 8)]
        out[more] = mix64(out[more] * _C + rest)
        k += 8
        more = more[size[more] > k]
    for i in np.flatnonzero(size > _LONG_WORD).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]], digest_size=8).digest(), "little")
    return out


class Words:
    """Word boundaries of folded texts, and hashes of runs of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.spaces = np.flatnonzero(data == 32)
        #: spaces[first[d] : first[d + 1]] are those of document d; it has one word fewer than spaces
        self.first = np.searchsorted(self.spaces, offsets)
        self.counts = np.maximum(np.diff(self.first) - 1, 0)
        #: words base[d] to base[d + 1] are those of document d
        self.base = np.concatenate([[0], np.cumsum(self.counts)])
        at = np.arange(self.base[-1]) + np.repeat(self.first[:-1] - self.base[:-1], self.counts)
        self.hashes = word_hashes(data, self.spaces[at] + 1, self.spaces[at + 1])
        self._blocks = {1: self.hashes}

    def digests(self) -> list[bytes]:
        """SHA-256 of every document's words."""
        view = memoryview(np.ascontiguousarray(self.data))
        return [hashlib.sha256(view[a:b]).digest() for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist())]

    def _block(self, size: int) -> np.ndarray:
        """Hashes of the ``size`` words from every word on; ``size`` is a power of two."""
        held = self._blocks.get(size)
        if held is None:
            half = self._block(size // 2)
            rest = half[size // 2 :]
            held = self._blocks[size] = mix64(half[: len(rest)] * _C + rest)
        return held

    def range_hash(self, start: np.ndarray, n: np.ndarray | int, least: int) -> np.ndarray:
        """Hashes of runs of ``n`` words from word ``start`` on, none shorter than ``least``, which takes part in the hash.

        Blocks of a power of two words, evenly spread so that they cover the run, are mixed one after another.
        """
        n = np.broadcast_to(np.asarray(n, np.int64), np.shape(start))
        size = 1 << (min(least, 32).bit_length() - 1)
        block = self._block(size)
        count = -(-n // size)
        out = mix64(n.astype(np.uint64) ^ _C)
        for k in range(int(count.max(initial=0))):
            live = np.flatnonzero(count > k) if k else np.arange(len(out))
            place = start[live] + (k * (n[live] - size)) // np.maximum(count[live] - 1, 1)
            out[live] = mix64(out[live] * _C + block[place])
        return out

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all ``width``-word runs, and the n+1 offsets by document.

        A document with fewer words has one run, all its words; one without words has none.
        """
        full = np.maximum(self.counts - width + 1, 0)
        short = (self.counts > 0) & (full == 0)
        n = np.where(short, 1, full)
        cuts = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(cuts[-1]) - np.repeat(cuts[:-1] - self.base[:-1], n)
        wide = np.repeat(np.where(short, self.counts, width), n)
        few = np.flatnonzero(wide < width)
        out = self.hashes[at].copy()
        for k in range(1, width):
            more = mix64(out * _C + self.hashes[np.minimum(at + k, len(self.hashes) - 1)])
            if len(few):
                still = few[wide[few] <= k]
                more[still] = out[still]
            out = more
        return out, cuts
