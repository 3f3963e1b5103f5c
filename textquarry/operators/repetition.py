"""Repetition measures of normalised texts, row by row in Arrow batches: no shuffle, linear in the words."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.functions.batches import release
from textquarry.functions.text import lengths_of

TOP = (2, 3, 4)
DUPE = (5, 6, 7, 8, 9, 10)
FIELDS = [*(f"top_{n}gram" for n in TOP), *(f"dupe_{n}grams" for n in DUPE), "entropy"]
RESULT = T.StructType([T.StructField(f, T.DoubleType()) for f in FIELDS])
#: Words handled at a time; each takes some 200 bytes while it is.
RUN_WORDS = 1 << 17


def _measure(words: pa.Array, cuts: np.ndarray) -> np.ndarray:
    """One row a document, one column a field; ``words`` of document d are those from cuts[d] to cuts[d + 1]."""
    n_docs, counts = len(cuts) - 1, np.diff(cuts)
    out = np.zeros((n_docs, len(FIELDS)))
    size = lengths_of(words)
    before = np.concatenate([[0], np.cumsum(size)])
    total = before[cuts[1:]] - before[cuts[:-1]]
    doc = np.repeat(np.arange(n_docs), counts)
    word = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    left = counts[doc] - (np.arange(len(word)) - cuts[:-1][doc])  # words from here to the document's end
    # ids of n-grams are unique to their document and rise with the first occurrence
    gram, _ = pd.factorize(doc * (int(word.max(initial=0)) + 1) + word)
    one = np.bincount(gram)
    owner = np.full(len(one), n_docs)
    owner[gram[::-1]] = doc[::-1]
    p = one / np.maximum(counts[np.minimum(owner, n_docs - 1)], 1) if n_docs else one
    entropy = np.zeros(n_docs)
    np.add.at(entropy, owner, -p * np.log(p))
    out[:, -1] = np.where(counts > 0, entropy, np.nan)
    base = int(word.max(initial=0)) + 1
    at = np.arange(len(word))
    for n in range(2, max(DUPE) + 1):
        keep = left[at] >= n
        at, prefix = at[keep], gram[keep]
        if not len(at):
            break
        gram, _ = pd.factorize(prefix * base + word[at + n - 1])
        times = np.bincount(gram)
        if n in TOP:
            own = doc[at]
            first = np.full(len(times), -1)
            first[gram[::-1]] = np.arange(len(at))[::-1]
            holder = own[first]  # documents of the n-grams, in rising order
            head = np.flatnonzero(np.concatenate([[True], holder[1:] != holder[:-1]]))
            most = np.maximum.reduceat(times, head)
            group = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(times))))
            hit = np.flatnonzero(times == most[group])
            best = hit[np.searchsorted(group[hit], np.arange(len(head)))]  # the first seen of the most frequent
            place = at[first[best]]
            chars = before[place + n] - before[place]
            d = holder[head]
            out[d, TOP.index(n)] = np.where(most > 1, chars * most / np.maximum(total[d], 1), 0.0)
        if n in DUPE:
            again = at[times[gram] > 1]
            edge = np.zeros(len(word) + 1, np.int64)
            np.add.at(edge, again, 1)
            np.add.at(edge, again + n, -1)
            covered = np.concatenate([[0], np.cumsum(np.where(np.cumsum(edge[:-1]) > 0, size, 0))])
            inside = covered[cuts[1:]] - covered[cuts[:-1]]
            out[:, len(TOP) + DUPE.index(n)] = inside / np.maximum(total, 1)
    return out


def _runs(cuts: np.ndarray):
    a, n = 0, len(cuts) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(cuts, cuts[a] + RUN_WORDS, "right")) - 1)
        yield a, min(b, n)
        a = b


def measure_batch(norm: pa.Array) -> pa.StructArray:
    split = pc.split_pattern(norm.fill_null(""), " ")
    words = pc.list_flatten(split)
    cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))])
    if len(words):  # an empty text splits into one empty word
        real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
        kept = np.concatenate([[0], np.cumsum(real)])
        words, cuts = words.filter(pa.array(real)), kept[cuts]
    parts = [_measure(words.slice(int(cuts[a]), int(cuts[b] - cuts[a])), cuts[a : b + 1] - cuts[a]) for a, b in _runs(cuts)]
    rows = np.concatenate(parts) if parts else np.zeros((0, len(FIELDS)))
    null = np.asarray(norm.is_null())
    return pa.StructArray.from_arrays([pa.array(rows[:, k], pa.float64(), mask=null | np.isnan(rows[:, k])) for k in range(len(FIELDS))], names=FIELDS)


def repetitions(norm: Column) -> Column:
    """Struct of all repetition measures and the unigram entropy; null measures for a null text, no entropy without words."""

    @F.arrow_udf(RESULT)
    def run(column: pa.Array) -> pa.Array:
        out = measure_batch(column)
        release()
        return out

    return run(norm)
