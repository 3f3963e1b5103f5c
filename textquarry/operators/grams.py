"""Counts of word n-grams over a corpus."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.functions import text as X
from textquarry.functions.batches import bytes_of, filled, kept, release, strings, tidied
from textquarry.plans.runtime import small_batches


#: A bucket holds about so many bytes of n-grams, which one worker counts at a time.
BUCKET_BYTES = 24 << 20
MOST_BUCKETS = 1 << 16
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def count_grams(norm: pa.Array, n: int, buckets: int = 1) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct n-grams of normalised texts, how often they occur, and the bucket of each, the same in every process."""
    data, offsets = bytes_of(filled(norm))
    solid = data != 32
    head = solid.copy()
    head[1:] &= ~solid[:-1]
    full = offsets[:-1][offsets[1:] > offsets[:-1]]
    head[full] = solid[full]
    starts = np.flatnonzero(head)
    doc = np.searchsorted(offsets, starts, "right") - 1
    code = strings(*kept(data, np.append(starts, len(data)), solid)).dictionary_encode()
    ids = code.indices.to_numpy().astype(np.int64)
    at = np.flatnonzero(doc[n - 1 :] == doc[: len(doc) - n + 1]) if len(doc) >= n else np.zeros(0, np.int64)
    # equal numbers for equal n-grams
    gram, base, most = ids[at], len(code.dictionary), len(code.dictionary)
    for k in range(1, n):
        if most * base >= 1 << 62:
            gram, seen = pd.factorize(gram)
            most = len(seen)
        gram, most = gram * base + ids[at + k], most * base
    which, seen = pd.factorize(gram)
    first = np.empty(len(seen), np.int64)
    first[which[::-1]] = at[::-1]
    hashed = np.fromiter(map(crc32, code.dictionary.cast(pa.large_binary()).to_pylist()), np.uint64, base)
    mixed = np.zeros(len(first), np.uint64)
    for k in range(n):
        mixed = (mixed + hashed[ids[first + k]] + np.uint64(1)) * _FACTOR
        mixed ^= mixed >> np.uint64(29)
    parts = [code.dictionary.take(pa.array(ids[first + k])) for k in range(n)]
    grams = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if n > 1 else parts[0]
    return grams, np.bincount(which, minlength=len(seen)), (mixed % np.uint64(buckets)).astype(np.uint16)


def _packed(grams: pa.Array, times: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket: its n-grams' bytes, their sizes and counts."""
    order = np.argsort(bucket, kind="stable")
    bucket, (data, offsets) = bucket[order], bytes_of(grams.take(pa.array(order)))
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, np.int64)
    column = lambda values, ends: pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])
    return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]].astype(np.int32)), column(data, offsets[cuts]), column(np.diff(offsets).astype(np.int32), 4 * cuts), column(times[order].astype(np.int64), 8 * cuts)], ["bucket", "grams", "sizes", "times"])


def _summed(rows: list[tuple[bytes, bytes, bytes]]):
    """Batches of gram, n of one bucket's packed rows."""
    data, sizes, times = (b"".join(x) for x in zip(*rows))
    sizes = np.frombuffer(sizes, np.int32)
    grams = strings(np.frombuffer(data, np.uint8), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]))
    code = grams.dictionary_encode()
    n = np.zeros(len(code.dictionary), np.int64)
    np.add.at(n, code.indices.to_numpy(), np.frombuffer(times, np.int64))
    for k in range(0, len(n), 1 << 15):
        yield pa.RecordBatch.from_arrays([code.dictionary.slice(k, 1 << 15).cast(pa.string()), pa.array(n[k : k + (1 << 15)])], ["gram", "n"])


def _sum_up(batches):
    """Rows come by bucket, so that one bucket is held at a time."""
    held, now = [], None
    for batch in batches:
        for bucket, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket != now and held:
                yield from _summed(held)
                held = []
                release()
            now = bucket
            held.append(row)
    if held:
        yield from _summed(held)


def gram_counts(docs: DataFrame, n: int, text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """gram, n: every run of ``n`` words of the normalised texts and how often it occurs.

    Batches of texts count their n-grams and pack them by bucket, so that few rows are shuffled and no table of n-grams
    is kept but that of one bucket. There are as many buckets as the texts' bytes ask for.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(4 * spark.sparkContext.defaultParallelism, -(-n * total // bucket_bytes)))

    def pack(batches):
        for batch in batches:
            yield _packed(*count_grams(tidied(batch.column(0)), n, buckets))
            release()

    small_batches(spark)
    packed = docs.select(X.plain_lower(F.col(text)).alias("text")).mapInArrow(pack, "bucket int, grams binary, sizes binary, times binary")
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_sum_up, "gram string, n bigint")
