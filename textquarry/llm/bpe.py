"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The corpus is cut into pre-tokens and its repeated ones are counted. The words of the table lie end to end in arrays of
byte symbols, a share of them in each task; an inverted index leads from the rank of a mergeable token pair to the
positions that hold it. All merges are replayed in rank order: one merge is applied at all its positions at once, and
only the pairs to the left and right of a merged position enter the index anew. Documents are written by looking their
pre-tokens up; those that the table has no room for are replayed in the same way, chunk by chunk. The result depends
neither on the table's size nor on the chunks, and every text is checked by decoding.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.arrays import gather, ragged, release, runs, text_bytes
from textquarry.llm.words import word_hashes
from textquarry.plans.runtime import small_batches, spread, write_shared

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-token pattern that goes with the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNK_BYTES = 2 << 20
CHUNKS_TOGETHER = 6
#: Tokens or words that are handled at once where places take many times the room of what they lead to.
PIECE = 1 << 16
#: Words that the table holds at most, the most used ones of the corpus; about 40 bytes each in every worker.
TABLE_WORDS = 1 << 19

ENCODED = "doc_id bigint, n_tokens bigint, token_ids array<int>, decoded_ok boolean"


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs ``at`` of ``values``, end to end, put together a piece at a time: their places take 24 bytes a value."""
    parts = [at[k : k + PIECE] for k in range(0, len(at), PIECE)]
    return np.concatenate([values[:0], *(values[gather(starts[x], lengths[x])] for x in parts)])


class Vocabulary:
    """Tokens by rank, the ranks of all mergeable pairs, and the bytes of every token in one array."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        tokens = [b""] * self.size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
        self._pairs = pairs
        keys = np.array(sorted(pairs), np.int64)
        values = np.array([pairs[k] for k in keys.tolist()], np.int64)
        bits = max(4, int(len(keys) * 4).bit_length())
        self._bits = np.uint64(64 - bits)
        # open addressing in whole-array steps: each key goes to the first free slot after its hash
        size = 1 << bits
        self._keys, self._ranks = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self._keys[at] == -1
            self._keys[at[free]] = keys[left[free]]
            self._ranks[at[free]] = values[left[free]]
            stay = self._keys[at] != keys[left]
            left, at = left[stay], (at[stay] + 1) % size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._bits).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, -1 where it makes none."""
        if len(left) > PIECE:
            return np.concatenate([self.pair_ranks(left[k : k + PIECE], right[k : k + PIECE]) for k in range(0, len(left), PIECE)])
        keys = left.astype(np.int64) * self.size + right
        if len(keys) <= 24:  # most merges of rare words: whole-array steps would cost more than the work
            return np.array([self._pairs.get(k, -1) for k in keys.tolist()], np.int32)
        at = self._slot(keys)
        out = np.full(len(keys), -1, np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            held = self._keys[at]
            same = held == keys[open_]
            out[open_[same]] = self._ranks[at[same]]
            go = ~same & (held != -1)
            open_, at = open_[go], (at[go] + 1) % len(self._keys)
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, end to end."""
        return gathered(self.bytes, self.starts, self.lengths, ids)


@lru_cache(maxsize=2)
def load_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def replay(data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of distinct words (bytes end to end) and the n+1 offsets by word."""
    n = len(data)
    # one sentinel before and after every word keeps pairs inside words
    words = len(offsets) - 1
    place = np.arange(n) + np.repeat(np.arange(words), np.diff(offsets)) + 1
    size = n + words + 1
    sym = np.full(size, -1, np.int32)
    sym[place] = vocabulary.byte_ids[data]
    del place
    nxt, prv = np.arange(1, size + 1, dtype=np.int32), np.arange(-1, size - 1, dtype=np.int32)
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def note(positions: np.ndarray, ranks: np.ndarray) -> None:
        held = ranks >= 0
        if not held.all():
            positions, ranks = positions[held], ranks[held]
        if not len(ranks):
            return
        if len(ranks) > 1:
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            heads = ranks[np.concatenate([[0], cuts])].tolist()
            parts = np.split(positions, cuts) if len(cuts) else [positions]
        else:
            heads, parts = [int(ranks[0])], [positions]
        for rank, part in zip(heads, parts):
            if rank in index:
                index[rank].append(part)
            else:
                index[rank] = [part]
                heapq.heappush(queue, rank)

    first = np.flatnonzero((sym[:-1] >= 0) & (sym[1:] >= 0)).astype(np.int32)
    note(first, vocabulary.pair_ranks(sym[first], sym[first + 1]))
    while queue:
        rank = heapq.heappop(queue)
        lists = index.pop(rank)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        right = nxt[at]
        ok = (sym[at] >= 0) & (sym[right] >= 0)
        at, right = at[ok], right[ok]
        if not len(at):
            continue
        ok = vocabulary.pair_ranks(sym[at], sym[right]) == rank  # entries that an earlier merge has changed go
        at, right = at[ok], right[ok]
        if not len(at):
            continue
        if len(at) > 1:
            clash = right[:-1] == at[1:]
            if clash.any():  # overlapping pairs as in "aaa": from the left, every other one
                start = np.concatenate([[True], ~clash])
                run = np.cumsum(start) - 1
                step = np.arange(len(at)) - np.flatnonzero(start)[run]
                at, right = at[step % 2 == 0], right[step % 2 == 0]
        after = nxt[right]
        sym[at], sym[right] = rank, -2
        nxt[at], prv[after] = after, at
        before = prv[at]
        left_at, right_at = before[sym[before] >= 0], at[sym[after] >= 0]
        note(left_at, vocabulary.pair_ranks(sym[left_at], sym[nxt[left_at]]))
        note(right_at, vocabulary.pair_ranks(sym[right_at], sym[nxt[right_at]]))
    live = sym >= 0
    before = np.concatenate([[0], np.cumsum(live)])
    bounds = offsets + np.arange(words + 1)
    return sym[live], before[bounds]


_L, _N, _S, _O = 0, 1, 2, 3


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point under the pattern: letter, number, white space, other."""
    points = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\x00" for c in range(0x110000))
    out = np.full(0x110000, _O, np.uint8)
    for kind, pattern in ((_L, r"\p{L}+"), (_N, r"\p{N}+"), (_S, r"\s+")):
        for m in regex.finditer(pattern, points):
            out[m.start() : m.end()] = kind
    return out


def _byte_classes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of the code point at each byte of valid UTF-8, and which bytes start one."""
    table = _classes()
    kind = table[x]
    if not (x >= 128).any():
        return kind, np.ones(len(x), bool)
    lead = (x & 0xC0) != 0x80
    wide = np.flatnonzero(x >= 0xC0)
    y = np.concatenate([x, np.zeros(3, np.uint8)]).astype(np.int64)
    a, b, c, d = y[wide], y[wide + 1] & 63, y[wide + 2] & 63, y[wide + 3] & 63
    point = np.where(a < 0xE0, ((a & 31) << 6) | b, np.where(a < 0xF0, ((a & 15) << 12) | (b << 6) | c, ((a & 7) << 18) | (b << 12) | (c << 6) | d))
    kind[wide] = table[np.minimum(point, 0x10FFFF)]
    follow = np.flatnonzero(~lead)
    starts = np.flatnonzero(lead)
    kind[follow] = kind[starts[np.searchsorted(starts, follow, "right") - 1]]
    return kind, lead


_SUFFIXES = {b"s": 1, b"t": 1, b"m": 1, b"d": 1, b"re": 2, b"ve": 2, b"ll": 2}


def pre_tokens(x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where pre-tokens of PATTERN start; texts lie end to end, n+1 ``offsets`` bound them."""
    n = len(x)
    if not n:
        return np.zeros(0, np.int64)
    kind, lead = _byte_classes(x)
    first = np.zeros(n, bool)  # starts of texts
    first[offsets[:-1][offsets[:-1] < n]] = True
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last character of a run of white space that more follows: a blank joins what follows, others stand alone
    space = kind == _S
    ends = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:])
    if len(ends):
        head = ends.copy()
        back = ~lead[head]
        while back.any():
            head[back] -= 1
            back = ~lead[head]
        start[head] = True
        blank = x[ends] == 32
        start[ends[blank] + 1] = False
    # 's, 't, 're, 've, 'm, 'll, 'd where the apostrophe starts a pre-token of its own
    mark = np.flatnonzero((x[:-1] == 39) & (kind[1:] == _L) & start[:-1] & ~first[1:])
    if len(mark):
        two = np.concatenate([x, np.zeros(2, np.uint8)])
        limit = offsets[np.searchsorted(offsets, mark, "right")]
        for p, end, c, d in zip(mark.tolist(), limit.tolist(), two[mark + 1].tolist(), two[mark + 2].tolist()):
            size = 1 if c in b"stmd" else 2 if bytes((c, d)) in _SUFFIXES and p + 3 <= end else 0
            if size:
                start[p + 1] = False
                if p + 1 + size < end and kind[p + 1 + size] == _L:
                    start[p + 1 + size] = True
    return np.flatnonzero(start)


def _cut_by_pattern(texts: list[str | None], pattern: str) -> np.ndarray:
    compiled, out, at = regex.compile(pattern), [], 0
    for text in texts:
        for part in compiled.findall(text or ""):
            out.append(at)
            at += len(part.encode())
    return np.array(out, np.int64)


class Cut:
    """The pre-tokens of texts that lie end to end: where they start, and which of the distinct words each one is."""

    def __init__(self, text: pa.Array, pattern: str = PATTERN):
        self.data, self.offsets = x, offsets = text_bytes(text)
        # equal words share one replay; words are told apart by a 64-bit hash of their bytes
        kind = np.int32 if len(x) < 1 << 31 else np.int64  # several chunks with all their places are held together
        places, hashes = [np.zeros(0, kind)], [np.zeros(0, np.uint64)]
        for a, b in runs(offsets):  # these steps hold several numbers a byte, the others only a few a word
            part, own = x[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            at = pre_tokens(part, own) if pattern == PATTERN else _cut_by_pattern(text.slice(a, b - a).to_pylist(), pattern)
            hashes.append(word_hashes(part, at, np.append(at[1:], len(part)) if len(at) else at))
            places.append((at + offsets[a]).astype(kind))
        self.starts = np.concatenate(places)
        word, self.hashes = pd.factorize(np.concatenate(hashes))
        self.word = word.astype(np.int32)
        first = np.empty(len(self.hashes), np.int64)
        first[self.word[::-1]] = np.arange(len(self.word))[::-1]
        self.first = self.starts[first]
        self.sizes = np.diff(np.append(self.starts, len(x)))[first]

    def words(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of distinct words, end to end, and the n+1 offsets."""
        sizes = self.sizes[some]
        return self.data[gather(self.first[some], sizes)], np.concatenate([[0], np.cumsum(sizes)])


class WordTable:
    """Token ids of words by the hashes of their bytes."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, ids: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.counts, self.ids = hashes[order], counts[order], ids
        self.starts = np.concatenate([[0], np.cumsum(counts)])[:-1][order]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of words in the table, -1 for those that it has not."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


def encode_all(texts: list[pa.Array], vocabulary: Vocabulary, pattern: str = PATTERN, table: WordTable | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each array of texts their token ids, end to end, the n+1 offsets by text, and the decoded bytes; a null text has none.

    The words that the table has not, of all arrays, are replayed together.
    """
    held, fresh = [], []
    for text in texts:
        cut = Cut(text, pattern)
        at = table.find(cut.hashes) if table is not None else np.full(len(cut.hashes), -1)
        fresh.append(cut.words(np.flatnonzero(at < 0)))
        held.append((cut.data, np.searchsorted(cut.starts, cut.offsets), cut.word, at))
        del cut
        release()
    sizes = [np.diff(offsets) for _, offsets in fresh]
    new_ids, new_bounds = replay(np.concatenate([x for x, _ in fresh]), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), vocabulary) if fresh else (None, None)
    release()
    first = 0
    for text, (x, word_cuts, word, at), own_sizes in zip(texts, held, sizes):
        new, old = np.flatnonzero(at < 0), np.flatnonzero(at >= 0)
        bounds = new_bounds[first : first + len(own_sizes) + 1]
        first += len(own_sizes)
        ids = new_ids[bounds[0] : bounds[-1]]
        counts, places = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        counts[new], places[new] = np.diff(bounds), bounds[:-1] - bounds[0]
        if len(old):
            there = at[old]
            counts[old] = table.counts[there]
            places[old] = len(ids) + np.cumsum(counts[old]) - counts[old]
            ids = np.concatenate([ids, table.ids[gather(table.starts[there], counts[old])]])
        flat = gathered(ids, places, counts, word)
        cuts = np.concatenate([[0], np.cumsum(counts[word])])
        flat_cuts = cuts[word_cuts]
        del cuts
        back = vocabulary.decode(flat)
        if len(back) != len(x) or (back != x).any():  # two words with one hash: replay every word by itself
            flat, bounds = replay(x, np.append(Cut(text, pattern).starts, len(x)), vocabulary)
            flat_cuts = bounds[word_cuts]
            back = vocabulary.decode(flat)
        yield flat, flat_cuts, back


def encode(text: pa.Array, vocabulary: Vocabulary, pattern: str = PATTERN, table: WordTable | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``encode_all`` of one array."""
    return next(encode_all([text], vocabulary, pattern, table))


def word_counts(docs: DataFrame, pattern: str = PATTERN, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """word, n of every pre-token of the corpus; counting begins in the chunks."""

    def run(batches):
        for table in chunks(batches, chunk_bytes):
            cut = Cut(table["text"].combine_chunks(), pattern)
            data, offsets = cut.words(np.arange(len(cut.hashes)))
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(cut.word, minlength=len(words)), pa.int64())], ["word", "n"])
            release()

    return spread(docs.select("text")).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def word_table(docs: DataFrame, vocabulary: Broadcast, pattern: str = PATTERN, most: int = TABLE_WORDS, chunk_bytes: int = CHUNK_BYTES) -> WordTable:
    """The merges replayed over the repeated words of the corpus, those used most where there are more than ``most``."""
    level = F.when(F.col("n") < 256, F.col("n")).otherwise((F.log2("n") * 32).cast("bigint"))  # 256 is level 256
    words = write_shared(word_counts(docs, pattern, chunk_bytes).where("n > 1").withColumn("level", level), "words")
    least, room = 0, most
    for r in sorted(words.groupBy("level").agg(F.count("*").alias("k")).collect(), key=lambda r: -r["level"]):  # some 2,000 levels
        room -= r["k"]
        if room < 0:
            least = r["level"] + 1
            break

    def run(batches):
        for table in chunks(batches, 1 << 20, "word"):
            column = table["word"].combine_chunks()
            data, offsets = text_bytes(column)
            ids, bounds = replay(data, offsets, vocabulary.value)
            ids = ids.astype(np.int32)
            columns = [pa.array(word_hashes(data, offsets[:-1], offsets[1:]).view(np.int64)), pa.array([ids[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["hash", "ids"])
            release()

    found = words.where(F.col("level") >= least).select("word").mapInArrow(run, "hash bigint, ids binary").toArrow().combine_chunks()
    if not found.num_rows:
        return WordTable(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32))
    data, offsets = text_bytes(found["ids"].combine_chunks())
    return WordTable(found["hash"].to_numpy().view(np.uint64), np.diff(offsets) // 4, np.frombuffer(data.tobytes(), np.int32))


def chunks(batches, size: int = CHUNK_BYTES, column: str = "text"):
    """Batches cut and joined into tables of about ``size`` bytes of text in ``column``."""
    held, bytes_ = [], 0
    for batch in batches:
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at, n = 0, batch.num_rows
        while at < n:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size - bytes_, "right")) - 1)
            held.append(batch.slice(at, end - at))
            bytes_ += int(offsets[end] - offsets[at])
            at = end
            if bytes_ >= size or at < n:
                yield pa.Table.from_batches(held)
                held, bytes_ = [], 0
    if held:
        yield pa.Table.from_batches(held)


def encode_decode(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN, chunk_bytes: int = CHUNK_BYTES, table_words: int = TABLE_WORDS) -> DataFrame:
    """doc_id, n_tokens, token_ids, and whether decoding the ids gives back the text's bytes.

    A null text has null ids and count and null in decoded_ok; an empty one has no ids and decodes to itself. Nothing
    is a special token. Repeated rows are encoded each; columns but doc_id and text play no part, whatever their names;
    texts are encoded whole, however long. An empty table gives no rows. Only the driver reads the vocabulary's file.
    """
    small_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    held = sc.broadcast(load_vocabulary(path))
    known = sc.broadcast(word_table(docs, held, pattern, table_words, chunk_bytes))

    def encoded(tables, vocabulary):
        """Chunks with their ids; the words of several that the table has not share one replay."""
        more = True
        while more:
            # only these copies are held, not the larger batches that the chunks are slices of
            some = [(table["doc_id"].combine_chunks(), table["text"].combine_chunks()) for table in islice(tables, CHUNKS_TOGETHER)]
            more = len(some) == CHUNKS_TOGETHER
            yield from zip(some, encode_all([text for _, text in some], vocabulary, pattern, known.value))

    def run(batches):
        vocabulary = held.value
        for (doc_ids, text), (flat, cuts, back) in encoded(chunks(batches, chunk_bytes), vocabulary):
            raw, offsets = text_bytes(text)
            sums = np.zeros(len(flat) + 1, np.int64)
            np.cumsum(vocabulary.lengths[flat], out=sums[1:])
            sums = sums[cuts]
            ok = np.diff(sums) == np.diff(offsets)
            if ok.all() and len(back) == len(raw):
                wrong = np.flatnonzero(back != raw)
                ok[np.searchsorted(offsets, wrong, "right") - 1] = False
            else:
                ok = np.array([bytes(back[sums[k] : sums[k + 1]]) == bytes(raw[offsets[k] : offsets[k + 1]]) for k in range(len(ok))])
            null = np.asarray(text.is_null())
            at = 0
            while at < len(ok):  # a few documents a batch: their ids are large
                end = max(at + 1, int(np.searchsorted(cuts, cuts[at] + (1 << 19), "right")) - 1)
                end = min(end, len(ok))
                ids = ragged(flat[cuts[at] : cuts[end]].astype(np.int32), cuts[at : end + 1] - cuts[at], pa.int32())
                if null[at:end].any():
                    ids = pa.array([None if x else y for x, y in zip(null[at:end], ids.to_pylist())], pa.list_(pa.int32()))
                count = pa.array(np.diff(cuts[at : end + 1]), pa.int64(), mask=null[at:end])
                good = pa.array(ok[at:end], pa.bool_(), mask=null[at:end])
                yield pa.RecordBatch.from_arrays([doc_ids.slice(at, end - at), count, ids, good], ["doc_id", "n_tokens", "token_ids", "decoded_ok"])
                at = end
            release()

    return spread(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")).mapInArrow(run, ENCODED)
