"""Exact deduplication against a historical index held in minimal perfect hashes.

The distinct SHA-256 digests of the history are split into shards; every shard gets a minimal perfect hash (levels of
collision-free bits, as in BBHash) whose slots hold the full digest and the winner's locator. New digests are looked
up in the shard they belong to: a slot with the same digest names the winner, any other digest is new and grouped with
its own kind. Every removal is checked byte by byte against the winner's text before it counts.

Only digests and locators are shuffled; texts move for the repeats alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.llm.arrays import mix64
from textquarry.plans.runtime import join_checked, unused_name, with_row_id, write_shared

#: Digests of one shard, historical and new ones together.
SLOTS_PER_SHARD = 1 << 20
GAMMA = 2.0
LEVELS = 48

INDEX = "shard bigint, sizes array<bigint>, bits binary, digests binary, doc_ids array<bigint>, rids array<bigint>"
FOUND = "digest binary, doc_id bigint, rid bigint, member boolean"


class PerfectHash:
    """Minimal perfect hash over rows of an n x 32 byte matrix; ``find`` answers -1 where no slot can hold the row."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        two = np.ascontiguousarray(keys[:, :16]).view("<u8")
        return (mix64(two[:, 0] + mix64(two[:, 1] + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct digests. Raises if two of them agree in the 128 bits that place them, which no two texts are known to do."""
        left, sizes, bits = keys, [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, int(GAMMA * len(left)))
            at = cls._place(left, level, size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[at]]
        if len(left):
            raise ValueError("two digests share their first 128 bits")
        return cls(np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool))

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = self.starts[level] + self._place(keys[open_], level, int(size))
            hit = self.bits[at]
            slot[open_[hit]] = self.rank[at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
        return slot


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint8).reshape(-1, 32)


def digests(docs: DataFrame) -> DataFrame:
    """Locator, doc_id, history flag and digest of every document with a text."""
    return docs.where("text IS NOT NULL").select("_rid", "doc_id", "_old", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))


def first_of(rows: DataFrame) -> DataFrame:
    """Winner (smallest doc_id, nulls last, then locator) and number of rows of each digest."""
    win = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("_rid").alias("rid"))).alias("win")
    return rows.groupBy("digest").agg(win, F.count("*").alias("n")).select("digest", "win.doc_id", "win.rid", "n")


def _shard(n: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(n))


def build_index(winners: DataFrame, shards: int) -> DataFrame:
    """One row a shard: level sizes, packed bits, and the slots' digests and winners in slot order."""

    def build(table: pa.Table) -> pa.Table:
        keys = _matrix(table["digest"])
        mph = PerfectHash.build(keys)
        slot = mph.find(keys)
        order = np.empty(len(keys), np.int64)
        order[slot] = np.arange(len(keys))
        row = {
            "shard": [table["shard"][0].as_py()], "sizes": [mph.sizes.tolist()], "bits": [np.packbits(mph.bits).tobytes()], "digests": [keys[order].tobytes()],
            "doc_ids": [table["doc_id"].take(pa.array(order)).to_pylist()], "rids": [table["rid"].take(pa.array(order)).to_pylist()],
        }
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.table([pa.array(v, t) for v, t in zip(row.values(), kinds)], names=list(row))

    keyed = winners.select(_shard(shards).alias("shard"), "digest", "doc_id", "rid")
    return keyed.groupBy("shard").applyInArrow(build, INDEX)


def look_up(fresh: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """For each new distinct digest the historical winner where there is one, its own first row otherwise."""

    def probe(new: pa.Table, held: pa.Table) -> pa.Table:
        keys, member = _matrix(new["digest"]), np.zeros(new.num_rows, bool)
        doc_id, rid = new["doc_id"].to_pylist(), new["rid"].to_pylist()
        if held.num_rows and len(keys):
            sizes = np.array(held["sizes"][0].as_py(), np.int64)
            bits = np.unpackbits(np.frombuffer(held["bits"][0].as_py(), np.uint8), count=int(sizes.sum())).astype(bool)
            slots = np.frombuffer(held["digests"][0].as_py(), np.uint8).reshape(-1, 32)
            slot = PerfectHash(sizes, bits).find(keys)
            at = np.flatnonzero(slot >= 0)
            at = at[(slots[slot[at]] == keys[at]).all(1)]
            member[at] = True
            old_ids, old_rids = held["doc_ids"][0].as_py(), held["rids"][0].as_py()
            for k in at:
                doc_id[k], rid[k] = old_ids[slot[k]], old_rids[slot[k]]
        return pa.table([new["digest"], pa.array(doc_id, pa.int64()), pa.array(rid, pa.int64()), pa.array(member)], names=["digest", "doc_id", "rid", "member"])

    left = fresh.select(_shard(shards).alias("shard"), "digest", "doc_id", "rid")
    return left.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(probe, FOUND)


def repeats(docs: DataFrame) -> DataFrame:
    """The documents to remove: _rid, doc_id, winner_rid, duplicate_of, found_in ('history' or 'group').

    ``docs`` has _rid, doc_id, text and _old, which tells the historical rows (null: not). Of each text one row stays: a historical one if there is
    any, else a new one; among these the smallest doc_id, null ids last, and of repeated rows the first. Null texts
    repeat nothing and stay; empty texts are texts like any other. Texts of any length are hashed and compared whole.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    keys = digests(docs)
    history = write_shared(first_of(keys.where("_old")), "history")
    fresh = write_shared(first_of(keys.where("NOT _old")), "fresh")
    known, new = history.count(), fresh.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(known + new) // SLOTS_PER_SHARD))
    index = write_shared(build_index(history, shards), "mph")
    sizes = fresh.select("digest", F.col("rid").alias("own"), "n")
    found = look_up(fresh, index, shards).join(sizes, "digest").where("member OR n > 1")
    named = F.when(F.col("member"), "history").otherwise("group").alias("found_in")
    groups = found.select("digest", F.col("doc_id").alias("duplicate_of"), F.col("rid").alias("winner_rid"), named, F.lit(False).alias("_old"))
    groups = groups.unionByName(history.where("n > 1").select("digest", F.col("doc_id").alias("duplicate_of"), F.col("rid").alias("winner_rid"), F.lit("history").alias("found_in"), F.lit(True).alias("_old")))
    groups = write_shared(groups, "repeated")
    pairs = join_checked(keys, groups, ["digest", "_old"], "inner", 96).where("_rid <> winner_rid").drop("digest", "_old")
    return byte_checked(docs, write_shared(pairs, "candidates"))


def byte_checked(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those ``pairs`` whose two texts are the same bytes."""
    n = pairs.count()
    texts = docs.select("_rid", "text")
    mine = join_checked(texts, pairs, "_rid", "inner", 64, n)
    wins = pairs.select(F.col("winner_rid").alias("_rid")).distinct()
    theirs = join_checked(texts, wins, "_rid", "left_semi", 16, n).select(F.col("_rid").alias("winner_rid"), F.col("text").alias("_won"))
    return mine.join(theirs, "winner_rid").where(F.col("text") == F.col("_won")).drop("text", "_won")


def historical_sources(docs: DataFrame) -> Column:
    """The history of the standing queries: the first half, by name, of the sources that the table has."""
    names = docs.where("source IS NOT NULL").select("source").distinct()
    ranked = names.agg(F.array_sort(F.collect_set("source")).alias("s")).select(F.expr("CASE WHEN size(s) > 1 THEN s[CAST(size(s) / 2 AS INT) - 1] END").alias("last"))
    last = ranked.first()["last"]
    return F.lit(False) if last is None else F.col("source") <= F.lit(last)


def exact_repeats(docs: DataFrame, old: Column | None = None) -> DataFrame:
    """doc_id, duplicate_of, found_in of every removed document; ``old`` tells the historical rows.

    See ``repeats`` for what is kept: null texts repeat nothing, empty and very long ones are texts like any other, of
    equal rows the first stays, ties go to the smallest doc_id. Null sources are not historical. An empty table gives no
    rows. Columns but doc_id, text and source play no part, whatever their names.
    """
    old = historical_sources(docs) if old is None else old
    rows = with_row_id(docs.select("doc_id", "text", F.coalesce(old, F.lit(False)).alias("_old")))
    return repeats(rows).select("doc_id", "duplicate_of", "found_in")


def drop_exact_repeats(docs: DataFrame, old: Column | None = None) -> DataFrame:
    """The documents that stay, all columns unchanged: those that ``exact_repeats`` doesn't remove.

    Rows with a null text stay. Working columns take names that the table has not.
    """
    old = historical_sources(docs) if old is None else old
    rid = unused_name(docs, "_rid")
    rows = with_row_id(docs, rid)
    narrow = rows.select(F.col(rid).alias("_rid"), "doc_id", "text", F.coalesce(old, F.lit(False)).alias("_old"))
    gone = write_shared(repeats(narrow).select(F.col("_rid").alias(rid)), "removed")
    return join_checked(rows, gone, rid, "left_anti", 16).drop(rid)
