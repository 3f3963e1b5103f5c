"""Benchmark decontamination by Wu-Manber multi-pattern search.

The test strings are all runs of ``NGRAM`` words of every benchmark item (the whole item where it is shorter, as a line of
its own where it has fewer than ``LINE_WORDS`` words, which may stand anywhere by chance). Over
their first m bytes a shift table, indexed by a hash of B-byte blocks, says how far a window can move; where it says
zero, the bucket of the window's last block and the hash of its first block select test strings, which are then
compared byte by byte. Thousands of windows advance side by side in one array operation.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.arrays import mix64, release, runs, text_bytes
from textquarry.llm.words import FOLD, fold_bytes, fold_text, framed
from textquarry.plans.runtime import quoted, small_batches, unused_name, write_shared

NGRAM = 10
#: Items of fewer words are test strings only as whole lines.
LINE_WORDS = 5
TABLE_BITS = 18
LANE_BYTES = 256
RUN_BYTES = 1 << 21
#: Bytes of test strings that one pass searches; a larger benchmark is split by item, and one part after another is held.
PATTERN_BYTES = 16 << 20

HITS = "array<struct<item:bigint,windows:bigint>>"


class Matcher:
    """Shift table and suffix buckets of one class of patterns (all at least ``m`` bytes long)."""

    def __init__(self, patterns: list[bytes], ids: np.ndarray):
        self.patterns, self.ids = patterns, ids
        self.m = min(map(len, patterns))
        self.block = min(8, max(1, self.m // 3))
        self.bits = TABLE_BITS
        heads = np.frombuffer(b"".join(p[: self.m] for p in patterns), np.uint8).reshape(-1, self.m)
        most = self.m - self.block + 1
        self.shift = np.full(1 << self.bits, most, np.int32)
        flat = np.ascontiguousarray(heads)
        for j in range(most):
            h = self._hash(self._load(flat[:, j : j + self.block]))
            np.minimum.at(self.shift, h, most - 1 - j)
        first, last = self._load(flat[:, : self.block]), self._load(flat[:, most - 1 :])
        key = self._pair(first, last)
        order = np.argsort(key, kind="stable")
        self.keys, self.order = key[order], order

    def _load(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.uint64)
        for k in range(self.block):
            out |= rows[:, k].astype(np.uint64) << np.uint64(8 * k)
        return out

    def _hash(self, blocks: np.ndarray) -> np.ndarray:
        return ((blocks * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    @staticmethod
    def _pair(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mix64(first + mix64(last))

    def search(self, data: np.ndarray) -> list[tuple[int, int]]:
        """(pattern, position) of every occurrence in ``data``."""
        n = len(data) - self.m + 1  # window starts
        if n <= 0:
            return []
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        words = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
        mask = np.uint64((1 << (8 * self.block)) - 1)
        tail = self.m - self.block
        at = np.arange(0, n, LANE_BYTES, dtype=np.int64)
        stop = np.minimum(at + LANE_BYTES, n)
        zero = []
        while len(at):
            move = self.shift[self._hash(words[at + tail] & mask)]
            still = at[move == 0]
            if len(still):
                zero.append(still)
            at = at + np.maximum(move, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        if not zero:
            return []
        starts = np.sort(np.concatenate(zero))
        key = self._pair(words[starts] & mask, words[starts + tail] & mask)
        lo, hi = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        raw, out = data, []
        for k in np.flatnonzero(hi > lo):
            s = int(starts[k])
            for p in self.order[lo[k] : hi[k]]:
                pattern = self.patterns[p]
                if raw[s : s + len(pattern)].tobytes() == pattern:
                    out.append((int(p), s))
        return out


def fold_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Framed texts folded like ``fold_bytes``, but with a line feed before, between and after the lines that hold words."""
    x = FOLD[data]
    x[data == 10] = 10
    x[offsets[:-1]] = 10
    gap = (x == 32) | (x == 10)
    head = gap.copy()
    head[1:] &= ~gap[:-1]
    head[offsets[:-1]] = True
    run = np.cumsum(head)
    feeds = np.bincount(run[x == 10], minlength=len(head) + 1) > 0
    at = np.flatnonzero(head)
    x[at] = np.where(feeds[run[at]], 10, 32)
    keep = ~gap | head
    before = np.concatenate([[0], np.cumsum(keep)])
    return x[keep], before[offsets]


class Searcher:
    """Patterns in classes, so that a few short ones don't shorten every shift; those of whole lines have texts of their own."""

    def __init__(self, patterns: dict[bytes, list[int]]):
        inner = [p for p in patterns if p[:1] == b" "]
        self.items = patterns
        self.parts = [Matcher(x, np.arange(len(x))) for x in ([p for p in inner if len(p) >= 32], [p for p in inner if len(p) < 32]) if x]
        lines = [p for p in patterns if p[:1] != b" "]
        self.lines = Matcher(lines, np.arange(len(lines))) if lines else None

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> list[dict[int, int]]:
        """For each framed text the items found and how many distinct test strings of each."""
        seen: list[set] = [set() for _ in range(len(offsets) - 1)]

        def look(parts: list[Matcher], x: np.ndarray, cuts: np.ndarray) -> None:
            for part in parts:
                found = part.search(x)
                doc = np.searchsorted(cuts, [s for _, s in found], "right") - 1
                for (p, _), d in zip(found, doc):
                    seen[d].add(part.patterns[p])

        if self.parts:
            look(self.parts, *fold_bytes(data, offsets))
        if self.lines:
            look([self.lines], *fold_lines(data, offsets))
        out = []
        for some in seen:
            count: dict[int, int] = {}
            for p in some:
                for item in self.items[p]:
                    count[item] = count.get(item, 0) + 1
            out.append(count)
        return out


def test_strings(items: list[tuple[int, str | None]], ngram: int = NGRAM, least: int = LINE_WORDS) -> dict[bytes, list[int]]:
    """Folded runs of words, each between spaces or, for items of fewer than ``least`` words, line feeds, with the items that hold them.

    Texts are taken as they are, without lower-casing.
    """
    out: dict[bytes, list[int]] = {}
    for item, text in items:
        words = fold_text(text, lower=False).split()
        if 0 < len(words) < least:
            out.setdefault(b"\n" + b" ".join(words) + b"\n", []).append(item)
        elif words:
            for run in {b" " + b" ".join(words[k : k + ngram]) + b" " for k in range(max(1, len(words) - ngram + 1))}:
                out.setdefault(run, []).append(item)
    return out


test_strings.__test__ = False


def searchers(benchmark: DataFrame, ngram: int = NGRAM, limit: int = PATTERN_BYTES) -> Iterator[Searcher]:
    """One searcher for a benchmark whose test strings fit ``limit`` bytes, else one after another for shares of its items."""
    # documents are lower-cased by the JVM, and so is the benchmark: other libraries know other letters
    items = benchmark.where("text IS NOT NULL AND item_id IS NOT NULL").select(F.col("item_id").cast("bigint").alias("item_id"), F.lower("text").alias("text"))
    size = items.agg(F.sum(F.octet_length("text").cast("bigint")).alias("b")).first()["b"] or 0
    parts = -(-size * ngram // limit) or 1
    for k in range(parts):
        share = items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == k) if parts > 1 else items
        found = test_strings([(r["item_id"], r["text"]) for r in share.toLocalIterator()], ngram)
        if found:
            yield Searcher(found)


def _hits(held: Broadcast):
    @F.arrow_udf(HITS)
    def hits(text: pa.Array) -> pa.Array:
        data, offsets = text_bytes(text)
        rows = []
        for a, b in runs(offsets, RUN_BYTES):
            own = offsets[a : b + 1] - offsets[a]
            rows += [[{"item": i, "windows": c} for i, c in sorted(found.items())] for found in held.value.hits(data[offsets[a] : offsets[b]], own)]
        release()
        return pa.array(rows, pa.list_(pa.struct([("item", pa.int64()), ("windows", pa.int64())])))

    return hits


def _searched(docs: DataFrame, keys: list[str], benchmark: DataFrame, ngram: int, limit: int) -> DataFrame:
    """``keys`` and the item and number of its test strings in ``h``, a row for each item that a document holds.

    A benchmark of one part is searched as the rows stream by. Of several parts one at a time is broadcast; what it finds
    is written before the next one is made, so that neither the driver nor a worker ever holds two.
    """
    small_batches(docs.sparkSession)
    sc, found, waiting = docs.sparkSession.sparkContext, [], None

    def rows(held: Broadcast) -> DataFrame:
        # the outer form keeps Spark from searching once more to filter by size
        return docs.select(*map(quoted, keys), F.explode_outer(_hits(held)(framed())).alias("h")).where("h IS NOT NULL")

    def finish(held: Broadcast) -> None:
        found.append(write_shared(rows(held), "hits"))
        held.destroy()

    for searcher in searchers(benchmark, ngram, limit):
        if waiting is not None:
            finish(waiting)
        waiting = sc.broadcast(searcher)
    if waiting is None:
        return docs.select(*map(quoted, keys), F.explode(F.array().cast(HITS)).alias("h"))
    if not found:
        return rows(waiting)
    finish(waiting)
    return reduce(DataFrame.unionByName, found)


def leaks(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM, limit: int = PATTERN_BYTES) -> DataFrame:
    """doc_id, item_id and the number of distinct test strings of the item that the document holds.

    Null and empty texts hold nothing; so does every text where the benchmark is empty. Items without words or item_id
    are no test strings; those of fewer than LINE_WORDS words are found as whole lines; equal items are all named, and
    repeated rows are found each. Texts are searched whole, however long. Columns but doc_id and text, and but item_id
    and text of the benchmark, play no part, whatever their names.
    """
    found = _searched(docs.select("doc_id", "text"), ["doc_id"], benchmark.select("item_id", "text"), ngram, limit)
    return found.select("doc_id", F.col("h.item").alias("item_id"), F.col("h.windows").alias("windows"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM, limit: int = PATTERN_BYTES) -> DataFrame:
    """The documents that hold no test string (see ``leaks``), all columns unchanged; null and empty texts stay.

    Working columns take names that the table has not.
    """
    small_batches(docs.sparkSession)
    sc, out = docs.sparkSession.sparkContext, docs
    parts = searchers(benchmark.select("item_id", "text"), ngram, limit)
    waiting = next(parts, None)
    while waiting is not None:
        held, hits = sc.broadcast(waiting), unused_name(out, "_hits")
        out, waiting = out.withColumn(hits, _hits(held)(framed())).where(F.size(hits) == 0).drop(hits), next(parts, None)
        if waiting is not None:  # what is left goes on to the next part
            out = write_shared(out, "unleaked")
            held.destroy()
    return out
