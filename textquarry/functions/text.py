"""Column builders of the scalar text operators. All of them stay in the JVM but for normalising and running offsets."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.functions.batches import release, tidied

#: Word characters and white space, spelled so that Java and RE2 agree.
WORD = r"[\p{L}\p{N}_]"
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
RAW_WORD = rf"{WORD}+|[^\p{{L}}\p{{N}}_{SPACE}]+"
LINE = r"[^\n]*\n|[^\n]+"
SENTENCE = rf"[^.!?]*{WORD}[^.!?]*"
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
PUNCTUATION = string.punctuation
BULLETS = "•‣▶◀◦■□▪▫–"
DIGITS = 8


def score(x: Column) -> Column:
    """A signal's number as it is stored: double, eight digits."""
    return F.round(x.cast("double"), DIGITS)


@F.arrow_udf(T.StringType())
def _nfd(column: pa.Array) -> pa.Array:
    return pc.utf8_normalize(column, form="NFD")


def nfd(c: Column) -> Column:
    """Canonical decomposition."""
    return _nfd(c)


@F.arrow_udf(T.StringType())
def _tidied(column: pa.Array) -> pa.Array:
    out = tidied(column)
    release()
    return out


def plain_lower(c: Column) -> Column:
    """Lower case for ``_tidied``, which deletes punctuation: only a capital sigma's lower case depends on the signs around it."""
    return F.when(F.contains(c, F.lit("Σ")), F.lower(F.translate(c, PUNCTUATION, ""))).otherwise(F.lower(c))


def trim_space(c: Column) -> Column:
    return F.regexp_replace(c, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def normalize(c: Column, *, signs: bool = False, case: bool = False, squeeze: bool = True, decompose: bool = True) -> Column:
    """Punctuation deleted (unless ``signs`` stay), lower case (unless ``case`` stays), single spaces, decomposed: in this order.

    The JVM's regular expressions take most of the time for the usual form, so that Arrow batches do all but its lower case.
    """
    if squeeze and decompose and not signs:
        return _tidied(c if case else plain_lower(c))
    if not signs:
        c = F.translate(c, PUNCTUATION, "")
    if not case:
        c = F.lower(c)
    if squeeze:
        c = F.trim(F.regexp_replace(c, rf"[{SPACE}]+", " "))
    return nfd(c) if decompose else c


def norm_words(norm: Column) -> Column:
    """Words of a normalised text; none for an empty one."""
    return F.when(norm == "", F.array().cast("array<string>")).otherwise(F.split(norm, " "))


def raw_words(text: Column) -> Column:
    """Runs of word characters and runs of signs."""
    return F.regexp_extract_all(text, F.lit(RAW_WORD), F.lit(0))


def lines(text: Column) -> Column:
    """Lines with their line feeds."""
    return F.regexp_extract_all(text, F.lit(LINE), F.lit(0))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _running(sizes: pa.Array) -> pa.Array:
    """Running sums of every list."""
    counts = np.diff(sizes.offsets.to_numpy()) if len(sizes) else np.zeros(0, np.int64)
    flat = sizes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(flat)])
    cuts = np.concatenate([[0], np.cumsum(counts)])
    own = sums[1:] - np.repeat(sums[cuts[:-1]], counts)
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(own, pa.int32()))


def line_spans(text: Column) -> Column:
    """array<struct<text,start,end>> of the lines; offsets count characters of the text as it is."""
    own = lines(text)
    ends = _running(F.coalesce(F.transform(own, F.length), F.array().cast("array<int>")))
    return F.transform(F.arrays_zip(own.alias("line"), ends.alias("end")), lambda x: F.struct(x["line"].alias("text"), (x["end"] - F.length(x["line"])).alias("start"), x["end"].alias("end")))


def ngrams(words: Column, n: int) -> Column:
    """All runs of ``n`` words, joined by spaces."""
    if n == 1:
        return words
    grams = F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.concat_ws(" ", F.slice(words, i, F.lit(n))))
    return F.when(F.size(words) >= n, grams).otherwise(F.array().cast("array<string>"))


def classifier_text(text: Column) -> Column:
    """The text on one line."""
    return trim_space(F.regexp_replace(text, BREAK, " "))


def text_span(text: Column, start: int, max_words: int) -> Column:
    """``max_words`` words from word ``start`` (from 0) of the lower-cased text without punctuation."""
    flat = F.translate(F.translate(text, string.ascii_uppercase + "\n", string.ascii_lowercase + " "), PUNCTUATION, "")
    words = F.filter(F.split(flat, " "), lambda w: w != "")
    return F.concat_ws(" ", F.slice(words, start + 1, max_words))


def little_endian(hexed: Column, size: int) -> Column:
    """Unsigned number from the first ``size`` bytes of a hex digest, least byte first."""
    return F.conv(F.concat(*[F.substring(hexed, 2 * k - 1, 2) for k in range(size, 0, -1)]), 16, 10)


def sha1_hash32(c: Column) -> Column:
    return little_endian(F.sha1(c), 4).cast("bigint")


def doc_id_hash(c: Column) -> Column:
    """Unsigned 64-bit document id."""
    return little_endian(F.sha1(c), 8).cast("decimal(20,0)")


def feature_bucket(gram: Column, buckets: int) -> Column:
    """Bucket of an n-gram: the first 32 bits of its MD5 modulo ``buckets``."""
    return (F.conv(F.substring(F.md5(gram), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


#: Year and week of a crawl as they stand in paths.
SNAPSHOT = r"\b([0-9]{4}-[0-9]{2})\b"


def snapshot_of(path: Column) -> Column:
    return F.regexp_extract(path, SNAPSHOT, 1)


def uri_id_of(path: Column) -> Column:
    """The path from the snapshot on."""
    return F.regexp_extract(path, SNAPSHOT + "/.*", 0)


def bucket_code(bucket: Column) -> Column:
    return F.when(bucket == "head", 0.0).when(bucket == "middle", 1.0).when(bucket == "tail", 2.0)


def occurrences(text: Column, what: str) -> Column:
    """Non-overlapping occurrences of a string."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))) / len(what)).cast("int")


def lengths_of(words: pa.Array) -> np.ndarray:
    return pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
