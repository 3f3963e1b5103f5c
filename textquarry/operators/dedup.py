"""Exact duplicates by digest and near duplicates by banded MinHash signatures."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.functions.batches import release
from textquarry.operators.components import connected_components
from textquarry.plans.runtime import join_checked, write_shared

PERMUTATIONS = 128
NGRAM = 13
SEED = 42
PRIME = (1 << 61) - 1
MASK = (1 << 32) - 1
#: Hashes permuted at a time.
TURN = 384
THRESHOLDS = (0.7, 0.8, 0.9, 1.0)


def repeats_of(rows: DataFrame, newest: str, order: list[str]) -> DataFrame:
    """All rows but the first of each ``digest``: of the largest value of ``newest``, then by ``order``.

    Rows equal in all these count one by one. Aggregation begins before the shuffle and winners join by digest, so that
    a digest of any number of rows is never one task's. Rows without a digest repeat nothing.
    """
    columns = rows.columns
    same = rows.where("digest IS NOT NULL").groupBy(*columns).agg(F.count("*").alias("_m"))
    newer = same.groupBy("digest", newest).agg(F.min(F.struct(*[F.struct(F.col(c).isNull(), c) for c in order])).alias("_f"), F.sum("_m").alias("_n"))
    best = newer.groupBy("digest").agg(F.max(F.struct(F.col(newest), "_f")).alias("_w"), F.sum("_n").alias("_n")).where("_n > 1")
    held = same.join(best, "digest")
    first = F.col(newest).eqNullSafe(F.col(f"_w.{newest}")) & (F.struct(*[F.struct(F.col(c).isNull(), c) for c in order]) == F.col("_w._f"))
    left = held.withColumn("_m", F.when(F.coalesce(first, F.lit(False)), F.col("_m") - 1).otherwise(F.col("_m"))).where("_m > 0")
    return left.withColumn("_m", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_m")))).select(*columns)


def exact_duplicates(docs: DataFrame, shard: str, doc_id: str, digest: Column) -> DataFrame:
    """shard_id, doc_id, digest of every row whose digest an earlier row has; the newest shard comes first.

    Only the three columns are shuffled.
    """
    rows = docs.select(F.col(shard).alias("shard_id"), F.col(doc_id).alias("doc_id"), F.regexp_replace(digest, "^sha1:", "").alias("digest"))
    return repeats_of(rows, "shard_id", ["doc_id"])


def duplicate_counts(duplicates: DataFrame) -> DataFrame:
    return duplicates.groupBy("shard_id").agg(F.count("*").alias("n_duplicates"))


@lru_cache(maxsize=1)
def permutations(n: int = PERMUTATIONS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of the hash permutations, drawn in turn."""
    draw = np.random.RandomState(seed)
    pairs = [(draw.randint(1, PRIME, dtype=np.uint64), draw.randint(0, PRIME, dtype=np.uint64)) for _ in range(n)]
    return np.array([a for a, _ in pairs], np.uint64), np.array([b for _, b in pairs], np.uint64)


def permutation_checksum() -> str:
    return hashlib.sha256(np.array(permutations(), dtype=np.uint64).tobytes()).hexdigest()


@lru_cache(maxsize=64)
def optimal_bands(threshold: float, n: int = PERMUTATIONS) -> tuple[int, int]:
    """Bands and rows with the smallest even-weighted area of false positives and negatives."""
    at, weight = np.polynomial.legendre.leggauss(96)

    def area(f, a: float, b: float) -> float:
        x = 0.5 * (b - a) * at + 0.5 * (b + a)
        return float(0.5 * (b - a) * (weight * f(x)).sum()) if b > a else 0.0

    best, found = None, (1, 1)
    for bands in range(1, n + 1):
        for rows in range(1, n // bands + 1):
            missed = lambda s, b=bands, r=rows: (1 - s**r) ** b
            error = 0.5 * area(lambda s: 1 - missed(s), 0.0, threshold) + 0.5 * area(missed, threshold, 1.0)
            if best is None or error < best - 1e-12:
                best, found = error, (bands, rows)
    return found


def hash_values(words: list[str], n: int = NGRAM) -> np.ndarray:
    """32-bit hashes of the distinct ``n``-grams, none if there are fewer words."""
    return _gram_hashes(" ".join(words).encode(), n)


def _gram_hashes(text: bytes, n: int) -> np.ndarray:
    """The same for a text of words with one space between them: its n-grams are ranges of its bytes."""
    if not text:
        return np.zeros(0, np.uint64)
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    starts, ends = [0, *(spaces + 1).tolist()], [*spaces.tolist(), len(text)]
    sha1 = hashlib.sha1
    grams = {text[a:b] for a, b in zip(starts, ends[n - 1 :])}
    digests = b"".join([sha1(g).digest() for g in grams])
    return np.frombuffer(digests, "<u4")[::5].astype(np.uint64)


def _permuted(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lower 32 bits of x * a + b, taken modulo 2^64 and then modulo 2^61 - 1."""
    prime, top = np.uint64(PRIME), np.uint64(61)
    x = x * a + b
    x = (x & prime) + (x >> top)
    return (x - np.where(x >= prime, prime, np.uint64(0))) & np.uint64(MASK)


@lru_cache(maxsize=1)
def _halves(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The permutations, and the lower halves of their multipliers and of their offsets plus 8, as columns."""
    a, b = permutations(n)
    return a, b, a.astype(np.uint32)[:, None], (b + np.uint64(8)).astype(np.uint32)[:, None]


@lru_cache(maxsize=1)
def _scratch(n: int) -> np.ndarray:
    return np.empty(n * TURN, np.uint32)


def signatures_of(parts: list[np.ndarray], n: int = PERMUTATIONS) -> np.ndarray:
    """The smallest permuted hash of each of ``n`` permutations, a row for each array of hashes, none of them empty.

    Reduced by 2^61 - 1, the lower half of x * a + b is the plain 32-bit product and sum plus 0 to 8. So the hash with the
    smallest sum has the smallest half too, unless another sum is within 8 of it or one is about to wrap (``v``, which is 8
    more, is below 8 then); in these rare cases all hashes are permuted in full.
    """
    a, b, factor, shift = _halves(n)
    each, first, chosen, whole = np.arange(n), [], [], {}
    for hashes in parts:
        first.append(len(chosen))
        for k in range(0, len(hashes), TURN):  # a long text takes several turns, each within the processor's cache
            x = hashes[k : k + TURN]
            v = _scratch(n)[: n * len(x)].reshape(n, -1)
            np.multiply(x.astype(np.uint32), factor, out=v)
            np.add(v, shift, out=v)
            at = v.argmin(1)
            low = v[each, at]
            v[each, at] = MASK
            if low.min() < 8 or (v.min(1) - low).min() <= 8:
                whole[len(chosen)] = _permuted(x[:, None], a, b).min(0)
            chosen.append(x[at])
    if not parts:
        return np.zeros((0, n), np.uint32)
    found = _permuted(np.stack(chosen), a, b)
    for k, row in whole.items():
        found[k] = row
    return np.minimum.reduceat(found, first).astype(np.uint32)


def _signed(column: pa.Array, n: int, ngram: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the texts that have one, a row each, and which texts those are."""
    rows, held, some = [np.zeros((0, n), np.uint32)], [], np.zeros(len(column), bool)
    for k, value in enumerate(column):
        h = _gram_hashes(value.as_buffer().to_pybytes() if value.is_valid else b"", ngram)
        if len(h):
            some[k] = True
            held.append(h)
        if len(held) == 256 or (held and k == len(column) - 1):
            rows.append(signatures_of(held, n))
            held = []
    return np.concatenate(rows), some


def signatures(norm: Column, n: int = PERMUTATIONS, ngram: int = NGRAM) -> Column:
    """array<bigint> signature of a normalised text; null for one of fewer than ``ngram`` words."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def run(column: pa.Array) -> pa.Array:
        rows, some = _signed(column, n, ngram)
        cuts = np.concatenate([[0], np.cumsum(some)]).astype(np.int32) * n
        return pa.ListArray.from_arrays(pa.array(cuts), pa.array(rows.reshape(-1).astype(np.int64)), mask=pa.array(~some))

    return run(norm)


def bands(signature: Column, threshold: float, n: int = PERMUTATIONS) -> Column:
    """array<string> of hex band keys, big-endian, of a signature column; slots beyond the last full band are not used."""
    count, rows = optimal_bands(threshold, n)
    parts = F.transform(signature, lambda v: F.lpad(F.hex(v), 8, "0"))
    keys = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.array_join(F.slice(parts, i * rows + 1, rows), ""))
    return F.when(signature.isNotNull(), keys)


#: The two capital hex digits of every byte.
_HEX = np.frombuffer("".join(f"{k:02X}" for k in range(256)).encode(), np.uint16)


def band_columns(norm: Column, thresholds: tuple[float, ...] = THRESHOLDS, n: int = PERMUTATIONS, ngram: int = NGRAM, spelled: bool = False) -> dict[str, Column]:
    """array<binary> columns ``signature_sim<threshold>``, the form that clustering reads: the bytes of ``bands``, cut in one pass.

    ``spelled``: array<string>, in hex, as ``bands`` has them.
    """
    shapes = [optimal_bands(t, n) for t in thresholds]
    kind, each = (T.StringType(), 8) if spelled else (T.BinaryType(), 4)

    @F.arrow_udf(T.StructType([T.StructField(f"b{k}", T.ArrayType(kind)) for k in range(len(shapes))]))
    def run(column: pa.Array) -> pa.Array:
        rows, some = _signed(column, n, ngram)
        big, columns = rows.astype(">u4"), []
        for count, size in shapes:
            data = np.ascontiguousarray(big[:, : count * size])
            data = _HEX[data.view(np.uint8)] if spelled else data
            keys = pa.Array.from_buffers(pa.string() if spelled else pa.binary(), len(big) * count, [None, pa.py_buffer((np.arange(len(big) * count + 1) * size * each).astype(np.int32)), pa.py_buffer(data)])
            columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some)]).astype(np.int32) * count), keys, mask=pa.array(~some)))
        release()
        return pa.StructArray.from_arrays(columns, names=[f"b{k}" for k in range(len(shapes))])

    found = run(norm)
    return {f"signature_sim{t}": found[f"b{k}"] for k, t in enumerate(thresholds)}


def minhash_rows(docs: DataFrame, norm: Column, thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """Add the columns of ``band_columns``."""
    return docs.withColumns(band_columns(norm, thresholds))


def lsh_edges(rows: DataFrame, node: str, keys: str) -> DataFrame:
    """Distinct edges src > dst: every member of a bucket to its smallest; ``keys`` is the array of band keys."""
    members = rows.where(F.col(keys).isNotNull()).select(F.col(node).alias("src"), F.posexplode(keys).alias("band", "key"))
    low = members.groupBy("band", "key").agg(F.min("src").alias("dst"), F.count("*").alias("n")).where("n > 1").drop("n")
    return members.join(low, ["band", "key"]).where("src <> dst").select("src", "dst").distinct()


def clusters(edges: DataFrame) -> DataFrame:
    """node, cluster_id: the smallest node of the component. Nodes without edges are in no cluster."""
    return connected_components(edges).select("node", F.col("component").alias("cluster_id"))


def signed(id_int: Column) -> Column:
    """Unsigned 64-bit id as a signed one that sorts alike, for ``clusters``."""
    return (id_int.cast("decimal(20,0)") - F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("bigint")


def unsigned(node: Column) -> Column:
    return (node.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("decimal(20,0)")


def attach_clusters(docs: DataFrame, found: DataFrame, node: str) -> DataFrame:
    """Documents that are in a cluster, with its id."""
    return join_checked(docs, write_shared(found.withColumnRenamed("node", node), "clusters"), node, "inner", 32)
