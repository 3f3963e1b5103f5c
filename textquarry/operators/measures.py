"""Word and line measures of texts in whole Arrow batches: one pass over a text's words, one over its lines."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.functions import text as X
from textquarry.functions.batches import bytes_of as _bytes
from textquarry.functions.batches import filled as _filled
from textquarry.functions.batches import release
from textquarry.functions.batches import runs as _runs
from textquarry.functions.batches import strings as _strings
from textquarry.functions.batches import unsigned

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
LINES = ("javascript", "terminal", "words", "uppercase", "numeric", "bullet")
LINE_RESULT = T.StructType([*(T.StructField(k, T.ArrayType(SPAN)) for k in LINES), T.StructField("n", T.IntegerType()), T.StructField("ellipsis", T.IntegerType())])
WORDS = ("raw", "no_letter", "caps", "stop", "words", "unique", "bad")
WORD_RESULT = T.StructType([T.StructField(k, T.IntegerType()) for k in WORDS])

_WORD, _SPACE, _UPPER, _LOWER, _LATIN = 1, 2, 4, 8, 16


@lru_cache(maxsize=1)
def _points() -> np.ndarray:
    """What each code point is: word character, white space, capital, small or title letter, ASCII letter."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        if kind[0] in "LN" or c == 95:
            out[c] = _WORD | (_UPPER if kind == "Lu" else _LOWER if kind in ("Ll", "Lt") else 0) | (_LATIN if c < 128 and kind[0] == "L" else 0)
    for a, b in ((9, 13), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        out[a : b + 1] = _SPACE
    return out


def _score(x: np.ndarray) -> np.ndarray:
    return np.floor(x * 1e8 + 0.5) / 1e8


# --- words


def raw_tokens(data: np.ndarray, offsets: np.ndarray):
    """Document, flags and content of every raw word."""
    point = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    flag = _points()[point]
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(lead, offsets)  # documents in code points
    kind = np.where(flag & _SPACE, 0, np.where(flag & _WORD, 1, 2)).astype(np.int8)
    head = np.ones(len(kind), bool)
    head[1:] = kind[1:] != kind[:-1]
    head[first[:-1][first[:-1] < len(kind)]] = True
    starts = np.flatnonzero(head & (kind > 0))
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint8), _strings(data[:0], np.zeros(1, np.int64))
    doc = np.searchsorted(first, starts, "right") - 1
    every = np.flatnonzero(head)
    place = np.searchsorted(every, starts)
    ends = np.append(every, len(kind))[place + 1]
    edge = np.append(lead, len(data))
    size = edge[ends] - edge[starts]
    solid = np.repeat(kind > 0, np.diff(edge))
    return doc, np.bitwise_or.reduceat(flag, starts), _strings(data[solid], np.concatenate([[0], np.cumsum(size)]))


def raw_counts(text: Column) -> Column:
    """Number of raw words of a text; 0 for a null one."""

    @F.arrow_udf(T.IntegerType())
    def run(column: pa.Array) -> pa.Array:
        data, offsets = _bytes(_filled(column))
        parts = [np.zeros(0, np.int64)]
        for a, b in _runs(offsets):
            parts.append(np.bincount(raw_tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[0], minlength=b - a))
        release()
        return pa.array(np.concatenate(parts).astype(np.int32))

    return run(text)


def _listed(lists: dict[str, set], names: list[str], words: pa.Array) -> np.ndarray:
    """Whether each word is in each language's list; the last row is for languages without one."""
    out = np.zeros((len(names) + 1, len(words)), bool)
    for k, name in enumerate(names):
        out[k] = pc.is_in(words, value_set=pa.array(sorted(lists[name]), words.type)).to_numpy(zero_copy_only=False)
    return out


def word_rows(text: pa.Array, norm: pa.Array, lang: pa.Array, stop: dict[str, set], bad: dict[str, set]) -> np.ndarray:
    """One row a document, one column for each of WORDS; -1 where a language has no stop words."""
    parts = [np.zeros((0, len(WORDS)), np.int64)]
    data, offsets = _bytes(_filled(text))
    norm, langs = _filled(norm), lang.to_pylist()
    for a, b in _runs(offsets):
        n = b - a
        out = np.zeros((n, len(WORDS)), np.int64)
        add = lambda rows, n=n: np.bincount(rows, minlength=n)
        doc, flag, tokens = raw_tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        out[:, 0] = add(doc)
        out[:, 1] = add(doc[(flag & _LATIN) == 0])
        out[:, 2] = add(doc[((flag & _UPPER) > 0) & ((flag & _LOWER) == 0)])
        code = tokens.dictionary_encode()
        ids = code.indices.to_numpy().astype(np.int64)
        names = sorted(stop)
        which = np.array([names.index(x) if x in stop else len(names) for x in langs[a:b]], np.int64)
        hit = _listed(stop, names, code.dictionary)[which[doc], ids] if len(ids) else np.zeros(0, bool)
        out[:, 3] = np.where(which < len(names), add(doc[hit]), -1)

        split = pc.split_pattern(norm.slice(a, n), " ")
        size = pc.list_value_length(split).to_numpy().astype(np.int64)
        code = pc.list_flatten(split).dictionary_encode()
        ids, doc, words = code.indices.to_numpy().astype(np.int64), np.repeat(np.arange(n), size), code.dictionary
        real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)[ids] if len(ids) else np.zeros(0, bool)  # an empty text splits into one empty word
        ids, doc = ids[real], doc[real]
        out[:, 4] = add(doc)
        out[:, 5] = add(np.unique(doc * max(1, len(words)) + ids) // max(1, len(words)))
        names = sorted(bad)
        which = np.array([names.index(x) if x in bad else len(names) for x in langs[a:b]], np.int64)
        if len(ids):
            hit = _listed(bad, names, words)[which[doc], ids]
            out[:, 6] = add(doc[hit])
            long = {name: {p for p in bad[name] if " " in p} for name in names}
            heads = _listed({name: {p.split(" ", 1)[0] for p in long[name]} for name in names}, names, words)[which[doc], ids]
            sizes = {name: sorted({1 + p.count(" ") for p in long[name]}) for name in names}
            for at in np.flatnonzero(heads).tolist():
                d = doc[at]
                for k in sizes[names[which[d]]]:
                    if at + k <= len(doc) and doc[at + k - 1] == d and " ".join([words[i].as_py() for i in ids[at : at + k].tolist()]) in long[names[which[d]]]:
                        out[d, 6] += 1
        parts.append(out)
    return np.concatenate(parts)


def word_measures(text: Column, norm: Column, lang: Column, stop: dict[str, list[str]], bad: dict[str, list[str]]) -> Column:
    """Struct of raw words, those without an ASCII letter, in capitals and in the language's stop list (null without one),

    and of normal words, distinct ones, and phrases of the language's block list (over all phrase lengths).
    """
    stops, bads = ({k: set(v) for k, v in x.items()} for x in (stop, bad))

    @F.arrow_udf(WORD_RESULT)
    def run(a: pa.Array, b: pa.Array, c: pa.Array) -> pa.Array:
        rows = word_rows(a, b, c, stops, bads).astype(np.int32)
        release()
        return pa.StructArray.from_arrays([pa.array(rows[:, k], pa.int32(), mask=rows[:, k] < 0) for k in range(len(WORDS))], names=list(WORDS))

    return run(text, norm, lang)


# --- lines


def _line_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where lines start, an empty last one included, and the document of each."""
    feeds = np.flatnonzero(data == 10) + 1
    starts = np.sort(np.concatenate([offsets[:-1], feeds]), kind="stable")
    # a line feed that ends a document starts an empty line of it, before the next document's own first
    owner = np.searchsorted(feeds, offsets[:-1], "left") + np.arange(len(offsets) - 1)
    doc = np.zeros(len(starts), np.int64)
    after = np.searchsorted(feeds, offsets[:-1], "right") + np.arange(len(offsets) - 1)
    head = np.where(np.isin(offsets[:-1], feeds), after, owner)
    doc[head] = 1
    return starts, np.cumsum(doc) - 1


def line_rows(text: pa.Array, flat: pa.Array):
    """``flat``: the texts as ``X.plain_lower`` makes them. Runs of documents: their number of lines, ends in characters, lines that end with an ellipsis, and the scores of each line."""
    text, flat = _filled(text), _filled(flat)
    data, offsets = _bytes(text)
    other, bounds = _bytes(flat)
    space = X.SPACE
    for a, b in _runs(offsets):
        x, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        y, cuts = unsigned(other[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
        starts, doc = _line_starts(x, own)
        ends = np.append(starts[1:], len(x))
        real = ends > starts  # the last line of a text that ends with a line feed, or of an empty one, is none
        line = _strings(x, np.append(starts[real], len(x)))
        begin, _ = _line_starts(y, cuts)
        bare = _strings(y, np.append(begin, len(y))).filter(pa.array(real))
        doc = doc[real]
        norm = pc.utf8_trim(pc.replace_substring_regex(bare, pattern=f"[{space}]+", replacement=" "), " ")
        empty = pc.equal(norm, "").to_numpy(zero_copy_only=False)
        spaces = pc.count_substring(norm, " ").to_numpy().astype(np.int64)
        chars = pc.utf8_length(line).to_numpy().astype(np.int64)
        script = np.zeros(len(line))
        some = np.flatnonzero(pc.match_substring(norm, "javascript").to_numpy(zero_copy_only=False))
        script[some] = [w.split(" ").count("javascript") for w in norm.take(pa.array(some)).to_pylist()]
        wide = np.flatnonzero(~pc.string_is_ascii(norm).to_numpy(zero_copy_only=False))
        length = pc.utf8_length(norm).to_numpy().astype(float)
        digits = pc.count_substring_regex(norm, r"\p{N}").to_numpy().astype(float)
        if len(wide):
            nfd = pc.utf8_normalize(norm.take(pa.array(wide)), "NFD")
            length[wide] = pc.utf8_length(nfd).to_numpy()
            digits[wide] = pc.count_substring_regex(nfd, r"\p{N}").to_numpy()
        met = lambda pattern, line=line: pc.match_substring_regex(line, pattern).to_numpy(zero_copy_only=False).astype(float)
        scores = {
            "javascript": script,
            "terminal": met(rf"[.!?”][{space}]*\z"),
            "words": np.where(empty, 0, spaces + 1).astype(float),
            "uppercase": pc.count_substring_regex(line, r"\p{Lu}").to_numpy() / np.maximum(chars, 1),
            "numeric": digits / np.maximum(length, 1),
            "bullet": met(rf"\A[{space}]*[{X.BULLETS}]"),
        }
        n = np.bincount(doc, minlength=b - a)
        total = np.cumsum(chars)
        heads = np.concatenate([[0], np.cumsum(n)])
        before = np.concatenate([[0], total])[heads[:-1]]
        yield n, (total - np.repeat(before, n)).astype(np.int32), chars.astype(np.int32), np.bincount(doc, weights=met(rf"(\.\.\.|…)[{space}]*\z"), minlength=b - a), {k: _score(v) for k, v in scores.items()}


def line_measures(text: Column) -> Column:
    """Struct of the spans and scores of every line, one array a measure, the number of lines and of those that end with an ellipsis.

    Lower-casing stays in the JVM like that of whole texts; normalised lines are decomposed where their length counts.
    """

    @F.arrow_udf(LINE_RESULT)
    def run(text: pa.Array, flat: pa.Array) -> pa.Array:
        n, end, size, dots = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0)]
        scores: dict[str, list] = {k: [np.zeros(0)] for k in LINES}
        for a, b, c, d, some in line_rows(text, flat):
            for held, v in ((n, a), (end, b), (size, c), (dots, d)):
                held.append(v)
            for k, v in some.items():
                scores[k].append(v)
        n, end, size = np.concatenate(n), np.concatenate(end), np.concatenate(size)
        cuts, start, stop = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(end - size), pa.array(end)
        spans = [pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays([start, stop, pa.array(np.concatenate(scores[k]))], names=["start", "end", "score"])) for k in LINES]
        release()
        return pa.StructArray.from_arrays([*spans, pa.array(n.astype(np.int32)), pa.array(np.concatenate(dots).astype(np.int32))], names=[*LINES, "n", "ellipsis"])

    return run(text, X.plain_lower(text))
