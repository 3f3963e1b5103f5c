"""Samples, chunks and token counts."""

from __future__ import annotations

import json
import os
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.functions import text as X
from textquarry.functions.batches import bytes_of, filled, release, runs, strings
from textquarry.plans.runtime import small_batches

SHARES = {"head": 0.1, "middle": 0.2, "tail": 0.7}


def stratified(docs: DataFrame, n: int, stratum: str, bucket: str, order: list[str], shares: dict[str, float] | None = None) -> DataFrame:
    """The first rows of every (stratum, bucket): an equal quota for each stratum, split over its buckets by ``shares``."""
    strata = docs.select(stratum).distinct().count()
    quota = max(1, n // max(1, strata))
    limit, most = F.lit(0), 0
    for name, share in (shares or SHARES).items():
        limit, most = F.when(F.col(bucket) == name, int(quota * share)).otherwise(limit), max(most, int(quota * share))
    place = F.row_number().over(Window.partitionBy(stratum, bucket).orderBy(*order))
    # the literal bound lets Spark drop rows beyond it before the shuffle
    return docs.withColumn("_n", place).where(F.col("_n") <= most).where(F.col("_n") <= limit).drop("_n")


def shuffled(docs: DataFrame, seed: int, id_columns: list[str], key: str = "_key") -> DataFrame:
    """All rows in the order of seeded hashes of their ids, which stay in the column ``key``: a range-partitioned sort.

    The same seed gives the same order however the table is split; rows of equal ids are interchangeable.
    """
    return docs.withColumn(key, F.md5(F.concat_ws("/", F.lit(str(seed)), *[F.col(c).cast("string") for c in id_columns]))).orderBy(key, *id_columns)


def first_n(docs: DataFrame, n: int, order: list[str]) -> DataFrame:
    return docs.orderBy(*order).limit(n)


def chunks(docs: DataFrame, paragraphs: int, most: int, text: str = "text") -> DataFrame:
    """Every ``paragraphs`` non-empty lines of a text joined by line feeds; at most ``most`` chunks, a rest is left out."""
    full = F.filter(X.lines(F.coalesce(F.col(text), F.lit(""))), lambda x: X.trim_space(x) != "")
    n = F.least(F.floor(F.size("_l") / paragraphs), F.lit(most)).cast("int")
    parts = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.array_join(F.slice("_l", k * paragraphs + 1, paragraphs), "\n")))
    return docs.withColumn("_l", full).select("*", F.posexplode(parts).alias("chunk", "chunk_text")).drop("_l")


def word_token_count(text: Column) -> Column:
    return F.size(X.raw_words(F.coalesce(text, F.lit("")))).cast("bigint")


_held: dict[str, tuple] = {}


def _tokenizer(content: str):
    """One tokenizer a worker and the counts it remembers, made when it is first needed."""
    if content not in _held:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # every core has a worker of its own
        from tokenizers import Tokenizer

        _held.clear()
        _held[content] = Tokenizer.from_str(content), {}
    return _held[content]


#: Bytes of white space that a piece never ends with, and bytes that end a longer white-space character.
_NO_END = np.zeros(256, bool)
_NO_END[[*range(0x21), 0x7F, *range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True


def _by_pieces(content: str) -> bool:
    """Whether a text's tokens are those of its pieces, cut before the spaces that follow anything but white space.

    So it is where words are found by the pattern of byte-level encoders, which never goes on over such a space, and
    where nothing else looks at a text as a whole.
    """
    made = json.loads(content)
    plain = all(made.get(k) is None for k in ("normalizer", "truncation", "padding", "post_processor"))
    words = made.get("pre_tokenizer") or {}
    added = made.get("added_tokens") or []
    alone = all(not (x.get("lstrip") or x.get("rstrip") or x.get("single_word") or any(c.isspace() for c in x["content"])) for x in added)
    return plain and alone and words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words.get("add_prefix_space") and not made["model"].get("dropout")


def _piece_counts(column: pa.Array, tokenizer, known: dict[bytes, int]) -> np.ndarray:
    """Tokens of every text, where the distinct pieces of a run are encoded once; ``known`` holds short ones' counts."""
    data, offsets = bytes_of(filled(column))
    parts = [np.zeros(0, np.int64)]
    for a, b in runs(offsets, PIECES_BYTES):
        x, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        head = np.zeros(len(x), bool)
        head[1:] = (x[1:] == 32) & ~_NO_END[x[:-1]]
        head[own[:-1][own[1:] > own[:-1]]] = True
        starts = np.flatnonzero(head)
        pieces = strings(x, np.append(starts, len(x))).dictionary_encode()
        names = pieces.dictionary.cast(pa.large_binary()).to_pylist()
        new = [w for w in names if w not in known]
        fresh = {}
        for k in range(0, len(new), 4096):
            some = new[k : k + 4096]
            fresh |= dict(zip(some, map(len, tokenizer.encode_batch_fast([w.decode() for w in some]))))
        count = np.array([known[w] if w in known else fresh[w] for w in names], np.int64)
        if len(known) < KNOWN_PIECES:
            known.update((w, c) for w, c in fresh.items() if len(w) <= 32)
        doc = np.searchsorted(own, starts, "right") - 1
        each = count[pieces.indices.to_numpy()] if len(starts) else np.zeros(0)
        parts.append(np.bincount(doc, weights=each, minlength=b - a).astype(np.int64))
    return np.concatenate(parts)


#: A worker remembers the counts of about so many pieces of 32 bytes at most, some 70 MB.
KNOWN_PIECES = 1 << 19
#: Pieces are told apart over about so many bytes.
PIECES_BYTES = 4 << 20


def pretrained_token_count(text: Column, path: str) -> Column:
    """Tokens under a pretrained tokenizer file, its special tokens included; only the driver reads the file."""
    with open(path, encoding="utf-8") as f:
        content = f.read()
    spark = SparkSession.getActiveSession()
    held, by_pieces = spark.sparkContext.broadcast(content), _by_pieces(content)
    small_batches(spark)

    @F.arrow_udf(T.LongType())
    def count(column: pa.Array) -> pa.Array:
        tokenizer, known = _tokenizer(held.value)
        if by_pieces:
            out = _piece_counts(column, tokenizer, known)
        else:
            out = [n for k in range(0, len(column), 256) for n in map(len, tokenizer.encode_batch_fast(column.slice(k, 256).fill_null("").to_pylist()))]
        release()
        return pa.array(out, pa.int64())

    return count(text)


#: All sets of more categories would be too many; choose those that matter.
MOST_CATEGORIES = 16


def category_sets(categories: list[str]) -> list[tuple[int, list[str]]]:
    """Ids of all non-empty sets of categories, by size, then in lexicographic order."""
    names = sorted(set(categories))
    if len(names) > MOST_CATEGORIES:
        raise ValueError(f"{len(names)} categories have too many sets; choose {MOST_CATEGORIES} at most")
    return list(enumerate(list(c) for size in range(1, len(names) + 1) for c in combinations(names, size)))


def domain_categories(pairs: DataFrame, index: DataFrame) -> DataFrame:
    """domain, category_id: the id of a domain's sorted set of categories. ``pairs``: domain, category; ``index``: category_id, categories."""
    sets = pairs.groupBy("domain").agg(F.array_sort(F.collect_set("category")).alias("categories"))
    return sets.join(index, "categories").select("domain", "category_id", "categories")
