"""Substring deduplication by suffix automata of reference shards.

Words are the letters. A window of LENGTH words repeats if an earlier document (smaller locator) holds the same
words. Winnowing picks a seed, the smallest hash of SEED-word runs, in every window; equal windows have equal seeds at
equal places, so only seeds that two documents share can lie in a repeat. The segments around shared seeds are dealt
to shards by seed. Each shard reads its segments in document order: an online suffix automaton of the documents so far
gives the matching statistics of the next one, whose new words then extend it. Windows whose statistic reaches LENGTH
are repeats; runs of them are the maximal spans. The owner of a window is the first document that holds it: the first
one to reach the automaton's state of its words.

Two kinds of segments go round the automata, with the same result: copies of a segment are matched once, as they have
the same windows; segments of a seed that is too frequent for one shard are compared window by window.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.llm.arrays import gather, release, runs, text_bytes
from textquarry.llm.words import Words, fold_bytes, framed
from textquarry.plans.runtime import join_checked, small_batches, spread, with_row_id, write_shared

LENGTH = 50
SEED = 10
RUN_BYTES = 1 << 19
#: Words of one reference shard; an automaton takes about 400 bytes a word.
SHARD_WORDS = 100_000
#: A seed that occurs more often would make its shard too large: its windows are grouped by hash, one by one.
HOT_SEED = 4096

SEEDS = "_rid bigint, seed bigint, low int, n int, same bigint"
SEGMENTS = "_rid bigint, seed bigint, same bigint, words binary"
WINDOWS = "_rid bigint, seed bigint, same bigint, at int, window bigint"
SPANS = "seed bigint, same bigint, low int, n int, owner bigint"
RUNS = "seed bigint, same bigint, runs array<struct<low:int,n:int,owner:bigint>>"


class Automaton:
    """Online suffix automaton over word hashes; every state knows the first document that reached it."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.len, self.owner = [-1], [0], [-1]

    def extend(self, words: list[int], owner: int) -> None:
        """Add the substrings of ``words``; those of a former call stay, and no match runs from one into the other."""
        nxt, link, length, own = self.next, self.link, self.len, self.owner
        last = 0
        for c in words:
            if c in nxt[last]:  # a former document has this path
                q = nxt[last][c]
                if length[q] == length[last] + 1:
                    last = q
                    continue
                clone = self._clone(q, length[last] + 1)
                p = last
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = clone
                last = clone
                continue
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            own.append(owner)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = self._clone(q, length[p] + 1)
                    while p != -1 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur

    def _clone(self, q: int, size: int) -> int:
        self.next.append(self.next[q].copy())
        self.len.append(size)
        self.link.append(self.link[q])
        self.owner.append(self.owner[q])
        return len(self.next) - 1

    def statistics(self, words: list[int], most: int | None = None) -> tuple[list[int], list[int]]:
        """For every position the length of the longest known run of words that ends there, and the first document that has it.

        Lengths are bounded by ``most``; the document is then the first that has the run's last ``most`` words.
        """
        nxt, link, length, own = self.next, self.link, self.len, self.owner
        state, size, sizes, owners = 0, 0, [], []
        for c in words:
            to = nxt[state].get(c)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = nxt[state].get(c)
            if to is not None:
                state, size = to, size + 1
                if most is not None and size > most:
                    size = most
                    while length[link[state]] >= most:
                        state = link[state]
            sizes.append(size)
            owners.append(own[state])
        return sizes, owners


def _window_seeds(hashes: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest value in every run of ``width`` values."""
    at, span = np.arange(len(hashes)), 1
    while span < width:
        step = min(span, width - span)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(hashes[b] < hashes[a], b, a)
        span += step
    return at


def seeds_of(w: Words, length: int = LENGTH, seed: int = SEED):
    """Document, seed hash, first window, number of windows and hash of the segment's words, of every seed of folded texts."""
    x, cuts = w.shingles(seed)
    width = length - seed + 1
    empty = np.zeros(0, np.int64)
    if len(x) < width:
        return empty, empty.astype(np.uint64), empty, empty, empty.astype(np.uint64)
    at = _window_seeds(x, width)
    runs_of = np.maximum(np.where(w.counts >= length, w.counts - length + 1, 0), 0)
    window = gather(cuts[:-1], runs_of)
    doc = np.repeat(np.arange(len(runs_of)), runs_of)
    chosen = at[window]
    head = np.ones(len(window), bool)
    head[1:] = (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(head)
    n = np.diff(np.append(first, len(window)))
    doc = doc[first]
    low = window[first] - cuts[doc]
    return doc, x[chosen[first]], low, n, w.range_hash(w.base[doc] + low, n + length - 1, length)


def find_seeds(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """All seeds of all documents."""

    def run(batches):
        for batch in batches:
            rid = batch.column(0).to_numpy()
            data, offsets = text_bytes(batch.column(1))
            for a, b in runs(offsets, RUN_BYTES):
                w = Words(*fold_bytes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
                doc, key, low, n, same = seeds_of(w, length, seed)
                columns = [pa.array(rid[a + doc], pa.int64()), pa.array(key.view(np.int64), pa.int64()), pa.array(low.astype(np.int32), pa.int32()), pa.array(n.astype(np.int32), pa.int32()), pa.array(same.view(np.int64), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["_rid", "seed", "low", "n", "same"])
            release()

    return spread(docs.select("_rid", "text")).select("_rid", framed().alias("text")).mapInArrow(run, SEEDS)


def _segments(batches, length: int):
    """Folded texts of a run with document, word start and number of windows of the listed segments, and their keys."""
    for batch in batches:
        rid = batch.column(0).to_numpy()
        data, offsets = text_bytes(batch.column(1))
        held = batch.column(2)
        bounds = held.offsets.to_numpy().astype(np.int64) - held.offsets[0].as_py()
        key, same, low, n = (held.flatten().field(k).to_numpy().astype(np.int64) for k in range(4))
        for a, b in runs(offsets, RUN_BYTES):
            w = Words(*fold_bytes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
            own = slice(int(bounds[a]), int(bounds[b]))
            doc = np.repeat(np.arange(b - a), np.diff(bounds[a : b + 1]))
            for c in range(0, len(doc), 4096):
                d = slice(c, c + 4096)
                yield w, doc[d], low[own][d], n[own][d], rid[a + doc[d]], key[own][d], same[own][d]
        release()


def cut_segments(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Word hashes of the segment around each listed seed; ``docs`` has _rid, text and the array ``seeds``."""

    def run(batches):
        for w, doc, low, n, rid, key, same in _segments(batches, length):
            size = n + length - 1
            ends = np.concatenate([[0], np.cumsum(size)])
            flat = (w.hashes[gather(w.base[doc] + low, size)] >> np.uint64(32)).astype(np.uint32)
            content = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(ends * 4), pa.py_buffer(flat)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(key, pa.int64()), pa.array(same, pa.int64()), content], ["_rid", "seed", "same", "words"])

    return docs.select("_rid", framed().alias("text"), "seeds").mapInArrow(run, SEGMENTS)


def cut_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """A hash of every window of the listed segments, with its place in the segment."""

    def run(batches):
        for w, doc, low, n, rid, key, same in _segments(batches, length):
            at = gather(np.zeros(len(doc), np.int64), n)
            window = w.range_hash(np.repeat(w.base[doc] + low, n) + at, length, length).view(np.int64)
            columns = [pa.array(np.repeat(v, n), pa.int64()) for v in (rid, key, same)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(at.astype(np.int32), pa.int32()), pa.array(window, pa.int64())], ["_rid", "seed", "same", "at", "window"])

    return docs.select("_rid", framed().alias("text"), "seeds").mapInArrow(run, WINDOWS)


def match_segments(firsts: DataFrame, shards: int, length: int = LENGTH) -> DataFrame:
    """Runs of windows of each distinct segment that earlier documents of its shard hold, each run with one owner."""

    def run(table: pa.Table) -> pa.Table:
        rid, seed, same = (table[c].to_numpy() for c in ("_rid", "seed", "same"))
        words = table["words"].to_pylist()
        automaton, out, k = Automaton(), ([], [], [], [], []), 0
        order = np.lexsort((same, seed, rid)).tolist()
        while k < len(order):
            end = k
            while end < len(order) and rid[order[end]] == rid[order[k]]:
                end += 1
            own = [np.frombuffer(words[i], np.uint32).tolist() for i in order[k:end]]
            for i, w in zip(order[k:end], own):
                sizes, owners = automaton.statistics(w, length)
                low, holder = -1, -1
                for at in range(length - 1, len(w) + 1):
                    now = owners[at] if at < len(w) and sizes[at] >= length else -1
                    if now != holder:
                        if holder >= 0:
                            for column, v in zip(out, (seed[i], same[i], low, at - length + 1 - low, holder)):
                                column.append(int(v))
                        low, holder = at - length + 1, now
            for w in own:
                automaton.extend(w, int(rid[order[k]]))
            k = end
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        return pa.table([pa.array(v, t) for v, t in zip(out, kinds)], names=["seed", "same", "low", "n", "owner"])

    return firsts.withColumn("shard", F.pmod(F.xxhash64("seed"), F.lit(shards))).groupBy("shard").applyInArrow(run, SPANS)


_OWNED = T.ArrayType(T.StructType([T.StructField("low", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("owner", T.LongType())]))
_PLACED = T.ArrayType(T.StructType([T.StructField("low", T.IntegerType()), T.StructField("n", T.IntegerType())]))


@F.arrow_udf(_OWNED)
def _owner_runs(n: pa.Array, first: pa.Array, runs_: pa.Array) -> pa.Array:
    """The runs of a segment's ``n`` windows with their owners; windows of no run belong to ``first``."""
    out = []
    for size, own, some in zip(n.to_pylist(), first.to_pylist(), runs_.to_pylist()):
        rows, at = [], 0
        for r in sorted(some or [], key=lambda r: r["low"]):
            if r["low"] > at:
                rows.append({"low": at, "n": r["low"] - at, "owner": own})
            rows.append(r)
            at = r["low"] + r["n"]
        if at < size:
            rows.append({"low": at, "n": size - at, "owner": own})
        out.append(rows)
    return pa.array(out, pa.list_(pa.struct([("low", pa.int32()), ("n", pa.int32()), ("owner", pa.int64())])))


def _listed(docs: DataFrame, segments: DataFrame) -> tuple[DataFrame, int]:
    """Documents with the array of their segments, and the number of segments."""
    by_doc = write_shared(segments.groupBy("_rid").agg(F.collect_list(F.struct("seed", "same", "low", "n")).alias("seeds")), "by-doc")
    n = by_doc.agg(F.sum(F.size("seeds")).alias("n")).first()["n"] or 0
    return join_checked(docs.select("_rid", "text"), by_doc, "_rid", "inner", 48, n), n


def repeated_windows(docs: DataFrame, length: int = LENGTH, seed: int = SEED, shard_words: int = SHARD_WORDS, hot: int = HOT_SEED) -> DataFrame:
    """_rid, low, n, owner: runs of repeated windows (first word, number of windows) and the first document with each of them."""
    small_batches(docs.sparkSession)
    found = write_shared(find_seeds(docs, length, seed), "seeds")
    seen = found.groupBy("seed").agg(F.min("_rid").alias("a"), F.max("_rid").alias("b"), F.min("same").alias("s"), F.max("same").alias("t"), F.count("*").alias("k"))
    shared = seen.where("a < b").select("seed", (F.col("s") != F.col("t")).alias("differ"), (F.col("k") > hot).alias("hot"))
    held = write_shared(found.join(shared, "seed"), "shared")
    groups = write_shared(held.groupBy("seed", "same").agg(F.min(F.struct("_rid", "low")).alias("at"), F.first("n").alias("n"), F.first("differ").alias("differ"), F.first("hot").alias("hot")).select("seed", "same", "at.*", "n", "differ", "hot"), "groups")
    # distinct segments of seeds with several are matched where their first document holds them first
    once = groups.where("differ")
    chosen, _ = _listed(docs, once.where("NOT hot"))
    words = once.where("NOT hot").agg(F.sum(F.col("n") + length).alias("w")).first()["w"] or 0
    matched = match_segments(cut_segments(chosen, length), max(1, -(-int(words) // shard_words)), length)
    chosen, n = _listed(docs, once.where("hot"))
    if n:
        windows = write_shared(cut_windows(chosen, length), "windows")
        owners = windows.groupBy("seed", "window").agg(F.min("_rid").alias("owner"), F.max("_rid").alias("last")).where("owner < last").drop("last")
        again = windows.join(owners, ["seed", "window"]).where("owner < _rid")
        again = again.groupBy("seed", "same", "owner").agg(F.array_sort(F.collect_list("at")).alias("places")).select("seed", "same", "owner", _joined("places").alias("r"))
        matched = matched.unionByName(again.select("seed", "same", F.explode_outer("r").alias("r"), "owner").where("r IS NOT NULL").select("seed", "same", "r.low", "r.n", "owner"))
    matched = matched.groupBy("seed", "same").agg(F.collect_list(F.struct("low", "n", "owner")).alias("runs"))
    runs_of = groups.select("seed", "same", "n", F.col("_rid").alias("first")).join(matched, ["seed", "same"], "left")
    runs_of = write_shared(runs_of.select("seed", "same", _owner_runs("n", "first", "runs").alias("runs")), "runs")
    every = held.select("_rid", "seed", "same", F.col("low").alias("base")).join(runs_of, ["seed", "same"])
    parts = every.select("_rid", "base", F.explode("runs").alias("r")).where("r.owner < _rid")
    return parts.select("_rid", (F.col("base") + F.col("r.low")).alias("low"), "r.n", "r.owner")


@F.arrow_udf(_PLACED)
def _joined(places: pa.Array) -> pa.Array:
    """Runs of consecutive numbers."""
    out = []
    for some in places:
        x = some.values.to_numpy()
        head = np.flatnonzero(np.concatenate([[True], np.diff(x) != 1]))
        out.append([{"low": int(x[a]), "n": int(b - a)} for a, b in zip(head, np.append(head[1:], len(x)))])
    return pa.array(out, pa.list_(pa.struct([("low", pa.int32()), ("n", pa.int32())])))


SPAN = T.StructType([T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("words", T.IntegerType())]))), T.StructField("text", T.StringType())])


_FOLDED_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def word_marks(text: str) -> list[tuple[int, int]]:
    """Start and end of every folded word, in characters of the text as it is."""
    return [m.span() for m in _FOLDED_WORD.finditer(text)]


def _cut_spans(text: pa.Array, ranges: pa.Array) -> pa.Array:
    bounds = ranges.offsets.to_numpy()
    flat = ranges.flatten()
    lows, highs = flat.field(0).to_numpy(), flat.field(1).to_numpy()
    bounds = bounds - bounds[0]
    out = []
    for k, t in enumerate(text):
        t = t.as_py()
        marks, spans, kept, at = word_marks(t), [], [], 0
        rows = slice(int(bounds[k]), int(bounds[k + 1]))
        for low, high in sorted(zip(lows[rows].tolist(), highs[rows].tolist())):
            start, end = marks[low][0], marks[high - 1][1]
            spans.append({"start": start, "end": end, "words": high - low})
            kept.append(t[at:start])
            at = end
        out.append({"spans": spans, "text": "".join([*kept, t[at:]])})
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32())])
    return pa.array(out, pa.struct([("spans", pa.list_(span)), ("text", pa.string())]))


cut_spans = F.arrow_udf(_cut_spans, SPAN)


def cut_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, shard_words: int = SHARD_WORDS, hot: int = HOT_SEED) -> DataFrame:
    """Documents with repeated spans: doc_id, n_spans, words_removed, spans (start, end, words), found_in, text.

    Of passages of ``length`` words or more that documents share, the first document (in the table's order) keeps its
    own; in every later one the maximal span is removed. Words are compared in lower case and without ASCII signs;
    start and end count characters. found_in lists the doc_ids of the first document with each window of ``length``
    words in the spans, null ids left out; null columns beside the text change nothing. A passage that only one document repeats within itself stays. Null, empty and shorter texts have no spans;
    texts are read whole. A copy of a whole document leaves an empty remainder but for signs around it. Repeated rows are
    documents like any other. An empty table gives no rows; columns but doc_id and text play no part, whatever their names.
    """
    rows = with_row_id(docs.select("doc_id", "text"))
    windows = write_shared(repeated_windows(rows, length, seed, shard_words, hot), "windows")
    ids = rows.select(F.col("_rid").alias("owner"), F.col("doc_id").alias("owner_id"))
    owners = windows.select("_rid", "owner").distinct()
    named = owners.join(ids, "owner").groupBy("_rid").agg(F.array_sort(F.collect_set("owner_id")).alias("found_in"))
    runs_ = Window.partitionBy("_rid").orderBy("low", "high")
    ranges = windows.select("_rid", "low", (F.col("low") + F.col("n") + (length - 1)).alias("high"))
    reach = F.max("high").over(runs_.rowsBetween(Window.unboundedPreceding, -1))
    islands = ranges.withColumn("open", F.when(reach >= F.col("low"), 0).otherwise(1)).withColumn("island", F.sum("open").over(runs_.rowsBetween(Window.unboundedPreceding, 0)))
    merged = islands.groupBy("_rid", "island").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    spans = write_shared(merged.groupBy("_rid").agg(F.collect_list(F.struct("low", "high")).alias("spans")).join(named, "_rid"), "spans")
    total = spans.agg(F.sum(F.size("spans") + F.size("found_in")).alias("n")).first()["n"] or 0
    cut = join_checked(rows, spans, "_rid", "inner", 48, total).select("doc_id", "found_in", cut_spans("text", "spans").alias("c"))
    words = F.aggregate("c.spans", F.lit(0).cast("bigint"), lambda a, s: a + s["words"])
    return cut.select("doc_id", F.size("c.spans").alias("n_spans"), words.alias("words_removed"), "c.spans", "found_in", "c.text")
