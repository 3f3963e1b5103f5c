"""Near-duplicate grouping by SuperMinHash.

Every word shingle walks through a random permutation of the signature's slots; the value it offers to a slot is the
step number plus a random fraction, so the ranks of one element are correlated and the signature varies less than
with independent hashes. Steps beyond the largest whole part left in a signature can't change it and are not taken.
Bands of slots select candidates; each is verified by the Jaccard similarity of the shingle sets, and union-find
groups what holds. Members of a bucket are compared with its smallest first; those that fail it meet the others, in
buckets with many of them through the rarest shingles alone, which no similar pair can differ in (a prefix filter).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.llm.arrays import mix64, ragged, release, runs, text_bytes
from textquarry.llm.words import Words, fold_bytes, framed
from textquarry.operators.components import connected_components
from textquarry.plans.runtime import join_checked, small_batches, spread, unused_name, with_row_id, write_shared

SLOTS = 128
BANDS = 32
SHINGLE = 3
THRESHOLD = 0.5
RUN_BYTES = 1 << 19
#: In a bucket with at most so many members that fail against its smallest, each is compared with all others.
FEW_FAILED = 16
#: Counters that tell common shingles from rare ones; any counts give right results.
COUNTERS = 1 << 16

_STEP = 0x9E3779B97F4A7C15
_FRACTION = np.uint64(25)


def signatures(shingles: np.ndarray, cuts: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures, one row a document: step number in the high 7 bits, 25 bits of fraction below.

    ``shingles`` are 64-bit hashes, those of document d at cuts[d] to cuts[d + 1]. Steps run side by side over all
    elements; after each, the documents whose slots all hold a smaller whole part are done. Without elements every
    slot stays at the largest value.
    """
    n = len(cuts) - 1
    sig = np.full((n, slots), 0xFFFFFFFF, np.uint32)
    flat = sig.reshape(-1)
    doc = np.repeat(np.arange(n), np.diff(cuts))
    x, perm = shingles, None
    for step in range(slots):
        r = mix64(x + np.uint64((step + 1) * _STEP % (1 << 64)))
        value = (r >> np.uint64(64) - _FRACTION).astype(np.uint32) | np.uint32(step << 25)
        k = step + (((r & np.uint64(0xFFFFFFFF)) * np.uint64(slots - step)) >> np.uint64(32)).astype(np.int64)
        if step == 0:
            first, slot = k, k
        else:
            rows = np.arange(len(x))
            slot = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[rows, step]
            perm[rows, step] = slot
        np.minimum.at(flat, doc * slots + slot, value)
        if step + 1 == slots:
            break
        most = (sig.max(1) >> np.uint32(25)).astype(np.int64)
        live = most[doc] > step  # another step offers values of at least step + 1
        if not live.any():
            break
        if not live.all() or step == 0:
            x, doc = x[live], doc[live]
            if step == 0:
                perm = np.tile(np.arange(slots, dtype=np.uint8), (len(x), 1))
                rows, held = np.arange(len(x)), first[live]
                perm[rows, 0] = held
                perm[rows, held] = 0
            else:
                perm = perm[live]
    return sig


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band of each signature; the band's number takes part."""
    rows = sig.shape[1] // bands
    part = sig[:, : bands * rows].reshape(len(sig), bands, rows).astype(np.uint64)
    key = np.tile(mix64(np.arange(1, bands + 1, dtype=np.uint64)), (len(sig), 1))
    for k in range(rows):
        key = mix64(key ^ part[:, :, k]) + key
    return key.view(np.int64)


def _folded_runs(text: pa.Array, size: int = RUN_BYTES):
    data, offsets = text_bytes(text)
    for a, b in runs(offsets, size):
        yield b - a, Words(*fold_bytes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))


@F.arrow_udf(T.StructType([T.StructField("same", T.BinaryType()), T.StructField("words", T.IntegerType()), T.StructField("keys", T.ArrayType(T.LongType()))]))
def _sketch(text: pa.Array) -> pa.Array:
    same, words, keys = [], [np.zeros(0, np.int64)], [pa.array([], pa.list_(pa.int64()))]
    for _, w in _folded_runs(text):
        x, cuts = w.shingles(SHINGLE)
        some = np.diff(cuts) > 0
        key = band_keys(signatures(x, cuts))[some]
        at = np.concatenate([[0], np.cumsum(some * BANDS)])
        keys.append(ragged(key.reshape(-1), at, pa.int64()))
        same += w.digests()
        words.append(w.counts)
    release()
    arrays = [pa.array(same, pa.binary()), pa.array(np.concatenate(words).astype(np.int32), pa.int32()), pa.concat_arrays(keys)]
    return pa.StructArray.from_arrays(arrays, names=["same", "words", "keys"])


@F.arrow_udf(T.BinaryType())
def _shingle_set(text: pa.Array) -> pa.Array:
    """Sorted distinct shingles as 64-bit hashes."""
    out = []
    for n, w in _folded_runs(text):
        x, cuts = w.shingles(SHINGLE)
        out += [np.unique(x[cuts[k] : cuts[k + 1]]).tobytes() for k in range(n)]
    release()
    return pa.array(out, pa.binary())


def _numbers(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint64)


@F.arrow_udf(T.DoubleType())
def _jaccard(left: pa.Array, right: pa.Array) -> pa.Array:
    out = []
    for a, b in zip(left, right):
        x, y = _numbers(a), _numbers(b)
        if len(x) > len(y):
            x, y = y, x
        common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(y) else 0
        out.append(common / max(1, len(x) + len(y) - common))
    return pa.array(out, pa.float64())


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Add the Jaccard similarity of the documents src and dst."""
    a = sets.select(F.col("_rid").alias("src"), F.col("set").alias("_a"))
    b = sets.select(F.col("_rid").alias("dst"), F.col("set").alias("_b"))
    return pairs.join(a, "src").join(b, "dst").select("src", "dst", _jaccard("_a", "_b").alias("jaccard"))


def shingle_counts(sets: DataFrame) -> np.ndarray:
    """How often shingles fall to each of COUNTERS counters, over all ``sets``."""

    def run(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount((_numbers(value) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["at", "n"])

    out = np.zeros(COUNTERS, np.int64)
    for r in sets.select("set").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():  # COUNTERS rows at most
        out[r["at"]] = r["n"]
    return out


def prefix_pairs(sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs src > dst, one of them lost, that can be similar; ``sets`` has _rid, set and lost.

    Shingles are ordered from rare to common. A set of n has at least ceil(threshold * n) in common with any similar one,
    so that one of its first n - ceil(threshold * n) + 1 is common to both; the smaller of the two shares still more, and
    fewer of its own are enough. Common shingles such as those of a template come last and select nothing.
    """
    counts = shingle_counts(sets)
    both = 2 * threshold / (1 + threshold)

    def run(batches):
        for batch in batches:
            rid, lost = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            for k, value in enumerate(batch.column(1)):
                x = _numbers(value)
                n = len(x)
                x = x[np.lexsort((x, counts[(x % np.uint64(COUNTERS)).astype(np.int64)]))][: n - int(np.ceil(threshold * n - 1e-9)) + 1]
                own = np.arange(len(x)) < n - int(np.ceil(both * n - 1e-9)) + 1
                columns = [pa.array(x.view(np.int64)), pa.array(np.full(len(x), rid[k])), pa.array(np.full(len(x), n)), pa.array(np.full(len(x), lost[k])), pa.array(own)]
                yield pa.RecordBatch.from_arrays(columns, ["token", "rid", "n", "lost", "own"])
            release()

    rows = write_shared(sets.select("_rid", "set", "lost").mapInArrow(run, "token bigint, rid bigint, n bigint, lost boolean, own boolean"), "prefixes")
    small, large = rows.where("own").alias("a"), rows.alias("b")
    met = (F.col("a.token") == F.col("b.token")) & (F.col("a.n") <= F.col("b.n")) & (F.col("a.n") >= F.col("b.n") * threshold - 1e-6) & (F.col("a.rid") != F.col("b.rid")) & (F.col("a.lost") | F.col("b.lost"))
    return small.join(large, met).select(F.greatest("a.rid", "b.rid").alias("src"), F.least("a.rid", "b.rid").alias("dst")).distinct()


def near_edges(docs: DataFrame, threshold: float = THRESHOLD, few: int = FEW_FAILED) -> DataFrame:
    """Edges (src, dst) of row locators whose components are the near-duplicate groups. ``docs`` has _rid and text.

    Texts of the same words, told by SHA-256, are one node and need no comparison. In every bucket of a band all members
    are verified against the smallest; those that fail are verified against all the others if they are ``few``, else
    against those that ``prefix_pairs`` can't rule out: the components are those of all verified pairs of a bucket,
    whatever its size, and the pairs stay in proportion to its members.
    """
    small_batches(docs.sparkSession)
    sketch = write_shared(spread(docs.select("_rid", "text")).select("_rid", _sketch(framed()).alias("s")).select("_rid", "s.*"), "sketch").where("words > 0")  # a filter before would sketch every text twice
    same = sketch.groupBy("same").agg(F.min("_rid").alias("dst"), F.count("*").alias("n")).where("n > 1")
    copies = write_shared(join_checked(sketch.select("_rid", "same"), same.select("same", "dst"), "same", "inner", 48).where("_rid <> dst").select(F.col("_rid").alias("src"), "dst"), "copies")
    distinct = join_checked(sketch, copies.select(F.col("src").alias("_rid")), "_rid", "left_anti", 16)
    members = distinct.select("_rid", F.explode("keys").alias("key"))
    buckets = write_shared(members.groupBy("key").agg(F.min("_rid").alias("lead"), F.count("*").alias("n")).where("n > 1"), "buckets")
    links = write_shared(join_checked(members, buckets, "key", "inner", 48), "links")
    stars = write_shared(links.where("_rid <> lead").select(F.col("_rid").alias("src"), F.col("lead").alias("dst")).distinct(), "candidates")
    ends = stars.select(F.col("src").alias("_rid")).unionByName(stars.select(F.col("dst").alias("_rid"))).distinct()
    chosen = join_checked(docs.select("_rid", "text"), write_shared(ends, "ends"), "_rid", "left_semi", 16)
    sets = write_shared(chosen.select("_rid", _shingle_set(framed()).alias("set")), "sets")
    checked = write_shared(_verified(stars, sets), "checked")
    failed = checked.where(F.col("jaccard") < threshold).select(F.col("src").alias("_rid"), F.col("dst").alias("lead"))
    wide = links.where("n > 2")
    lost = write_shared(wide.join(failed, ["_rid", "lead"], "left_semi").select("key", F.col("_rid").alias("lost")), "lost")
    crowd = lost.groupBy("key").agg(F.count("*").alias("k"))
    others = wide.where("_rid <> lead").join(lost.join(crowd.where(F.col("k") <= few), "key", "left_semi"), "key").where("_rid <> lost")
    rest = others.select(F.greatest("_rid", "lost").alias("src"), F.least("_rid", "lost").alias("dst")).distinct()
    crowded = write_shared(crowd.where(F.col("k") > few).select("key"), "crowded")
    if not crowded.isEmpty():
        mine = wide.join(crowded, "key", "left_semi").select("_rid").distinct().join(lost.select(F.col("lost").alias("_rid"), F.lit(True).alias("lost")).distinct(), "_rid", "left")
        rest = rest.unionByName(prefix_pairs(sets.join(mine, "_rid").withColumn("lost", F.coalesce("lost", F.lit(False))), threshold)).distinct()
    rest = write_shared(rest.join(checked, ["src", "dst"], "left_anti"), "rest")
    more = write_shared(_verified(rest, sets), "verified")
    good = checked.unionByName(more).where(F.col("jaccard") >= threshold).select("src", "dst")
    return good.unionByName(copies)


def near_groups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """_rid, doc_id, group_id, group_size, kept of every document that has near duplicates; ``docs`` has _rid.

    The row with the smallest doc_id of a group stays (null ids last, then the first row) and its doc_id names the
    group. Null, empty and wordless texts are in no group. A text of fewer than SHINGLE words is one shingle. Repeated
    rows are near duplicates of each other. Texts are read whole. An empty table gives no rows; columns but doc_id and
    text play no part.
    """
    found = connected_components(near_edges(docs, threshold)).select(F.col("node").alias("_rid"), "component")
    rows = join_checked(docs.select("_rid", F.col("doc_id")), write_shared(found, "components"), "_rid", "inner", 32)
    rows = write_shared(rows, "grouped")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_rid")
    heads = rows.groupBy("component").agg(F.min(order).alias("w"), F.count("*").alias("group_size"))
    heads = heads.select("component", F.col("w.doc_id").alias("group_id"), F.col("w._rid").alias("_head"), "group_size")
    return rows.join(heads, "component").select("_rid", "doc_id", "group_id", "group_size", (F.col("_rid") == F.col("_head")).alias("kept"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, group_id, group_size, kept of every document that has near duplicates.

    The row with the smallest doc_id of a group stays (null ids last, then the first row) and names it. Null, empty and
    wordless texts are in no group; repeated rows are near duplicates of each other; very long texts are read whole. An
    empty table gives no rows. Columns but doc_id and text play no part, whatever their names.
    """
    return near_groups(with_row_id(docs.select("doc_id", "text")), threshold).drop("_rid")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without near duplicates and one of each group (see ``near_duplicates``), all columns unchanged.

    Null, empty and wordless texts stay. Working columns take names that the table has not.
    """
    rid = unused_name(docs, "_rid")
    rows = with_row_id(docs, rid)
    narrow = rows.select(F.col(rid).alias("_rid"), "doc_id", "text")
    gone = write_shared(near_groups(narrow, threshold).where("NOT kept").select(F.col("_rid").alias(rid)), "near")
    return join_checked(rows, gone, rid, "left_anti", 16).drop(rid)
