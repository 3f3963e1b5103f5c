"""Hashed n-gram models, importance weights and classifiers.

What a document's n-grams add up to is computed beside the document, in Arrow batches: no n-gram is shuffled, only the
counts of models are, added up in every task before.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.functions import text as X
from textquarry.functions.batches import bytes_of, filled, release, runs
from textquarry.operators.measures import raw_counts, raw_tokens
from textquarry.plans.runtime import small_batches, write_shared

BUCKETS = 10_000
FLOOR = 1e-8
#: N-grams are hashed once for about so many bytes of text.
GRAM_BYTES = 2 << 20

_TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_SINES = [np.uint32(int(abs(math.sin(k + 1)) * (1 << 32))) for k in range(64)]
#: Messages hashed at a time, within the processor's cache.
_LANES = 4096


def _first_words(block: np.ndarray) -> np.ndarray:
    """First word of the MD5 of padded messages of one block: 16 words, one row a word."""
    start = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    a, b, c, d = (np.full(block.shape[1], x, np.uint32) for x in start)
    t, u = np.empty_like(a), np.empty_like(a)
    for k in range(64):
        turn = k // 16
        if turn < 2:  # a choice by b, or by d
            x, y, z = (b, c, d) if turn == 0 else (d, b, c)
            np.bitwise_xor(y, z, t)
            np.bitwise_and(t, x, t)
            np.bitwise_xor(t, z, t)
            g = k if turn == 0 else (5 * k + 1) % 16
        elif turn == 2:
            np.bitwise_xor(b, c, t)
            np.bitwise_xor(t, d, t)
            g = (3 * k + 5) % 16
        else:
            np.bitwise_not(d, t)
            np.bitwise_or(t, b, t)
            np.bitwise_xor(t, c, t)
            g = (7 * k) % 16
        np.add(t, a, t)
        np.add(t, _SINES[k], t)
        np.add(t, block[g], t)
        left = _TURNS[turn][k % 4]
        np.left_shift(t, np.uint32(left), u)
        np.right_shift(t, np.uint32(32 - left), t)
        np.bitwise_or(t, u, t)
        np.add(t, b, t)
        a, d, c, b, t = d, c, b, t, a
    return a + start[0]


def _hashed(grams: pa.Array, buckets: int) -> np.ndarray:
    """Buckets of n-grams by the first four bytes of their MD5; those of up to 55 bytes, one block, in whole arrays."""
    data, offsets = bytes_of(grams)
    size, first = np.diff(offsets), np.zeros(len(grams), np.uint32)
    short = size <= 55
    for a in range(0, len(size), _LANES):
        n = min(_LANES, len(size) - a)
        own, fit = size[a : a + n], short[a : a + n]
        part = data[offsets[a] : offsets[a + n]]
        within = np.arange(len(part)) - np.repeat(offsets[a : a + n] - offsets[a], own)
        place = np.repeat(np.arange(n) * 64, own) + within
        block = np.zeros(n * 64, np.uint8)
        if fit.all():
            block[place] = part
        else:
            fits = np.repeat(fit, own)
            block[place[fits]] = part[fits]
        length = np.where(fit, own, 0)
        block[np.arange(n) * 64 + length] = 0x80
        words = block.view("<u4").reshape(n, 16)
        words[:, 14] = 8 * length
        first[a : a + n] = _first_words(np.ascontiguousarray(words.T))
    for k in np.flatnonzero(~short).tolist():
        first[k] = int.from_bytes(hashlib.md5(data[offsets[k] : offsets[k + 1]].tobytes()).digest()[:4], "little")
    return first.byteswap().astype(np.int64) % buckets


def gram_buckets(text: pa.Array, buckets: int = BUCKETS):
    """Buckets of the unigrams and bigrams of texts: rows first to last, each n-gram's row and bucket, and the number of unigrams, which come first."""
    data, offsets = bytes_of(filled(text))
    for at, end in runs(offsets, GRAM_BYTES):
        row, _, words = raw_tokens(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
        flat = words.dictionary_encode()
        ids, names = flat.indices.to_numpy().astype(np.int64), flat.dictionary
        pair = np.flatnonzero(row[1:] == row[:-1])
        both, distinct = pd.factorize(ids[pair] * len(names) + ids[pair + 1])
        one = _hashed(names, buckets)
        two = _hashed(pc.binary_join_element_wise(*(names.take(pa.array(x)) for x in np.divmod(distinct, max(1, len(names)))), pa.scalar(" ", pa.large_string())), buckets)
        yield at, end, np.concatenate([row, row[pair]]), np.concatenate([one[ids], two[both]]), len(row)


def hash_features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """doc_id, bucket, cnt of a document's unigrams and bigrams. Rows of equal doc_id are counted apart."""

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("cnt", T.LongType())])))
    def count(texts: pa.Array) -> pa.Array:
        sizes, bucket, cnt = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b, row, x, _ in gram_buckets(texts, buckets):
            key, n = np.unique(row * buckets + x, return_counts=True)
            sizes.append(np.bincount(key // buckets, minlength=b - a))
            bucket.append(key % buckets)
            cnt.append(n)
        release()
        items = pa.StructArray.from_arrays([pa.array(np.concatenate(bucket).astype(np.int32)), pa.array(np.concatenate(cnt).astype(np.int64))], names=["bucket", "cnt"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)), items)

    small_batches(docs.sparkSession)
    found = docs.select(F.col(doc_id).alias("doc_id"), F.explode_outer(count(text)).alias("f")).where("f IS NOT NULL")
    return found.select("doc_id", "f.bucket", "f.cnt")


def ngram_model(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, by: str | None = None, sizes: bool = False) -> DataFrame:
    """bucket, cnt over a corpus, or over each part of it that a string column ``by`` names; every task hands on one count a bucket.

    With ``sizes`` the number of texts that aren't null comes along as bucket ``buckets``, that of raw words as the next one.
    """

    def run(batches):
        held: dict[str | None, np.ndarray] = {}
        for batch in batches:
            parts = batch.column(1).to_pylist()
            if len(set(parts)) == 1:
                groups = {parts[0]: batch.column(0)}
            else:
                groups = {p: batch.column(0).filter(pa.array([x == p for x in parts])) for p in set(parts)}
            for part, texts in groups.items():
                total = held.setdefault(part, np.zeros(buckets + 2, np.int64))
                total[buckets] += len(texts) - texts.null_count
                for _, _, _, x, words in gram_buckets(texts, buckets):
                    total[:buckets] += np.bincount(x, minlength=buckets)
                    total[buckets + 1] += words
            release()
        for part, total in held.items():
            at = np.flatnonzero(total if sizes else total[:buckets])
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], ["part", "bucket", "cnt"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(text).alias("text"), (F.col(by) if by else F.lit("")).cast("string").alias("part"))
    found = rows.mapInArrow(run, "part string, bucket int, cnt bigint").groupBy("part", "bucket").agg(F.sum("cnt").alias("cnt"))
    return found.withColumnRenamed("part", by) if by else found.drop("part")


def gram_sums(text: Column, tables: np.ndarray, mean: bool = False) -> Column:
    """array<double>: the sum (or mean) over a document's n-grams of their buckets' values, for each row of ``tables``.

    Null for a document without words.
    """

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def run(column: pa.Array) -> pa.Array:
        parts = [np.zeros((0, len(tables)))]
        for a, b, row, x, _ in gram_buckets(column, tables.shape[1]):
            n = np.bincount(row, minlength=b - a)
            sums = np.stack([np.bincount(row, weights=t[x], minlength=b - a) for t in tables], 1) if len(tables) else np.zeros((b - a, 0))
            sums = sums / np.maximum(n, 1)[:, None] if mean else sums
            parts.append(np.where((n > 0)[:, None], sums, np.nan))
        rows = np.concatenate(parts)
        release()
        cuts = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(tables))
        return pa.ListArray.from_arrays(cuts, pa.array(rows.reshape(-1), pa.float64(), from_pandas=True))

    return run(text)


def mean_words(docs: DataFrame, text: str = "text", by: str | None = None) -> DataFrame:
    """The mean number of raw words of a text, the Poisson parameter of lengths: one row, or one for each value of ``by``."""
    small_batches(docs.sparkSession)
    rows = docs.select(*([by] if by else []), raw_counts(F.col(text)).alias("_n"))
    return rows.groupBy(*([by] if by else [])).agg(F.avg("_n").alias("lambda"))


def log_ratios(target: DataFrame, source: DataFrame) -> DataFrame:
    """bucket, lr = ln(p + floor) - ln(q + floor); a bucket that one model lacks counts 0 there. At most BUCKETS rows."""
    every = Window.partitionBy(F.lit(0))  # one task for BUCKETS rows
    share = lambda m, name: m.select("bucket", (F.col("cnt") / F.sum("cnt").over(every)).alias(name))
    both = share(target, "p").join(share(source, "q"), "bucket", "full_outer")
    ln = lambda c: F.ln(F.coalesce(F.col(c), F.lit(0.0)) + FLOOR)
    return both.select("bucket", (ln("p") - ln("q")).alias("lr"))


def ratio_table(ratios: DataFrame, columns: list[str], buckets: int = BUCKETS) -> np.ndarray:
    """Values by bucket, one row for each of ``columns``, 0 for buckets that ``ratios`` lacks; it has ``buckets`` rows at most."""
    out = np.zeros((len(columns), buckets))
    for r in ratios.select("bucket", *columns).collect():
        for k, c in enumerate(columns):
            out[k, r["bucket"]] = r[c] or 0.0
    return out


def importance(docs: DataFrame, ratios: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """doc_id, importance: sum of the log ratios of a document's n-grams, for documents that have any."""
    small_batches(docs.sparkSession)
    sums = gram_sums(F.col(text), ratio_table(ratios, ["lr"], buckets))
    # the outer form keeps Spark from adding up once more to filter
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode_outer(sums).alias("importance")).where("importance IS NOT NULL")


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series eight steps up, right to twelve digits."""
    y = x + 8
    series = (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    down = F.lit(0.0)
    for k in range(8):
        down = down + F.ln(x + k)
    return series - down


def log_poisson(k: Column, rate: Column) -> Column:
    """ln(P(k) + floor) of a Poisson distribution."""
    return F.ln(F.exp(k * F.ln(rate) - rate - log_gamma(k + 1.0)) + FLOOR)


def length_correction(n: Column, target_rate: Column, source_rate: Column) -> Column:
    """What the text's length adds to its importance; the caller chooses whether ``n`` counts characters or words."""
    return log_poisson(n.cast("double"), target_rate) - log_poisson(n.cast("double"), source_rate)


def linear_score(docs: DataFrame, weights: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """doc_id, score of a frozen linear model: the logistic function of the mean weight of a document's n-grams."""
    small_batches(docs.sparkSession)
    mean = gram_sums(F.col(text), ratio_table(weights, ["weight"], buckets), mean=True)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.explode_outer(mean).alias("mean")).where("mean IS NOT NULL")
    return rows.select("doc_id", (1 / (1 + F.exp(-F.col("mean")))).alias("score"))


def train_classifier(samples: DataFrame, text: str = "text", label: str = "label", buckets: int = 1 << 14):
    """Fitted text classifier: hashed words and logistic regression; ``samples`` has a text and a 0/1 label."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    words = RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"\s+")
    hashed = HashingTF(inputCol="_tokens", outputCol="_features", numFeatures=buckets)
    model = LogisticRegression(featuresCol="_features", labelCol=label, probabilityCol="_p", predictionCol="_y", rawPredictionCol="_z", regParam=0.01, maxIter=30)
    # chosen once: every pass of the training reads the rows that were chosen, in tasks of their own
    rows = write_shared(samples.select(text, F.col(label).cast("double").alias(label)), "samples")
    return Pipeline(stages=[words, hashed, model]).fit(rows)


def with_classifier(model, docs: DataFrame, column: str, text: str = "text") -> DataFrame:
    """``docs`` with the probability of label 1 in ``column``, null for an empty text; row by row, without a join."""
    from pyspark.ml.functions import vector_to_array

    words = model.stages[0]
    flat = f"{column}_flat"
    rows = docs.withColumn(flat, X.classifier_text(F.coalesce(F.col(text), F.lit(""))))
    made = model.transform(rows, {words.inputCol: flat})
    score = F.when(F.length(flat) > 0, X.score(vector_to_array("_p")[1]))
    return made.withColumn(column, score).drop(flat, "_tokens", "_features", "_z", "_p", "_y")


def classifier_scores(model, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score: the probability of label 1; null for an empty text."""
    return with_classifier(model, docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "score").select("doc_id", "score")


def _first(rows: DataFrame, n: int, order: Column) -> DataFrame:
    """The first ``n`` rows by a bigint ``order``. Only its numbers are sorted and cut off; rows stay in the tasks that read them."""
    if n <= 0:
        return rows.limit(0)
    last = rows.select(order.alias("k")).orderBy("k").limit(n).agg(F.max("k").alias("k"), F.count("*").alias("n")).first()
    if last["n"] < n:
        return rows
    below = rows.where(order < last["k"])
    return below.unionByName(rows.where(order == last["k"]).limit(n - below.count()))


def balanced(targets: list[DataFrame], rest: DataFrame, per_class: int, order: Column) -> DataFrame:
    """Training rows: an equal share of each target with label 1, as many of the rest with label 0, by the given order, a bigint."""
    share = per_class // max(1, len(targets))
    parts = [_first(t, share, order).withColumn("label", F.lit(1)) for t in targets]
    out = _first(rest, per_class, order).withColumn("label", F.lit(0))
    for p in parts:
        out = out.unionByName(p)
    return out
