"""Language identification by multilingual mixture inference.

Every language is a smoothed multinomial over hashed byte trigrams; one more component, ``und``, is uniform and takes
what no language explains. Expectation-maximisation estimates each document's proportions over these components, and
backward elimination picks the language set: the weakest component is dropped as long as the penalised
log-likelihood (log-likelihood less ``penalty * log(n)`` for each component) rises.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textquarry.llm.arrays import release, runs, text_bytes
from textquarry.plans.runtime import small_batches, spread, unused_name

BUCKETS = 1 << 13
TRAIN_TEXTS_PER_LANG = 2000
PENALTY = 3.0
UND_SHARE = 0.5

VERDICT = "struct<lang:string,langs:array<string>,shares:array<double>,n_grams:bigint,rejected:boolean>"

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram bucket ids of a run of texts, and the n+1 offsets that split them by text.

    Digits, signs and white space count as one kind of gap; trigrams with two gaps or more are left out.
    """
    n = len(offsets) - 1
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    x = _LETTERS[data].astype(np.uint32)
    code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    gap = (x == 32).astype(np.uint8)
    keep = (gap[:-2] + gap[1:-1] + gap[2:]) < 2
    for cut in (1, 2):  # trigrams that reach into the next text
        at = offsets[1:-1] - cut
        keep[at[(at >= 0) & (at < len(keep))]] = False
    # a text of one byte: its own start is at -1 from the next one's, covered above
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - 13)
    before = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    return bucket[keep].astype(np.int64), before[np.minimum(offsets, len(keep))]


def em_shares(counts: np.ndarray, like: np.ndarray, start: np.ndarray, steps: int = 40, tol: float = 1e-3):
    """Mixture proportions and log-likelihood; ``like`` has one row a gram and one column a component."""
    shares, total = start / start.sum(), counts.sum()
    mass = np.maximum(like @ shares, 1e-300)
    for _ in range(steps if like.shape[1] > 1 else 0):
        new = shares * (like.T @ (counts / mass)) / total
        moved = np.abs(new - shares).max()
        shares = new
        mass = np.maximum(like @ shares, 1e-300)
        if moved < tol:
            break
    return shares, float(counts @ np.log(mass))


def choose_languages(counts: np.ndarray, like: np.ndarray, penalty: float = PENALTY):
    """Component indexes and their shares, largest first, by backward elimination."""
    cost = penalty * np.log(max(counts.sum(), 2.0))
    live = np.arange(like.shape[1])
    shares, fit = em_shares(counts, like, np.ones(len(live)))
    while len(live) > 1:
        rest = np.delete(np.arange(len(live)), int(np.argmin(shares)))
        fewer, worse = em_shares(counts, like[:, live[rest]], np.maximum(shares[rest], 1e-6))
        if worse + cost < fit:
            break
        live, shares, fit = live[rest], fewer, worse
    order = np.lexsort((live, -shares))
    return live[order], shares[order]


def infer(column: pa.Array, names: list[str], like: np.ndarray, penalty: float = PENALTY, und_share: float = UND_SHARE) -> pa.Array:
    """Verdicts for lower-cased texts. ``like``: buckets x components, the last one is ``und``."""
    data, offsets = text_bytes(column)
    out = {k: [] for k in ("lang", "langs", "shares", "n_grams", "rejected")}
    every = [*names, "und"]
    for a, b in runs(offsets):
        own = offsets[a : b + 1] - offsets[a]
        grams, cuts = gram_buckets(data[offsets[a] : offsets[b]], own)
        for k in range(b - a):
            g = grams[cuts[k] : cuts[k + 1]]
            if not len(g) or not names:
                live, shares = [len(names)], [1.0]
            else:
                if len(g) > BUCKETS // 4:
                    dense = np.bincount(g, minlength=BUCKETS)
                    seen = np.flatnonzero(dense)
                    counts = dense[seen].astype(float)
                else:
                    seen, counts = np.unique(g, return_counts=True)
                    counts = counts.astype(float)
                live, shares = choose_languages(counts, like[seen], penalty)
            part = {every[i]: float(s) for i, s in zip(live, shares)}
            known = [i for i in live if i < len(names)]
            out["lang"].append(every[known[0]] if known and part.get("und", 0.0) < und_share else "und")
            out["langs"].append(list(part))
            out["shares"].append([round(s, 4) for s in part.values()])
            out["n_grams"].append(len(g))
            out["rejected"].append(out["lang"][-1] == "und")
    kinds = (pa.string(), pa.list_(pa.string()), pa.list_(pa.float64()), pa.int64(), pa.bool_())
    return pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))


def train(docs: DataFrame, per_lang: int = TRAIN_TEXTS_PER_LANG, smooth: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Language names and the matrix of gram probabilities (buckets x languages, then ``und``).

    Fitted on at most ``per_lang`` distinct texts of each labelled language, those with the smallest hashes; rows
    without a label or a text are no examples.
    """
    keyed = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.xxhash64("text").alias("_h"), "text")
    first = Window.partitionBy("lang").orderBy("_h")
    picked = keyed.select("lang", "_h").distinct().withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= per_lang)
    last = {r["lang"]: r["top"] for r in picked.groupBy("lang").agg(F.max("_h").alias("top")).collect()}
    names = sorted(last)
    if not names:
        return [], np.full((BUCKETS, 1), 1.0 / BUCKETS)
    within = F.lit(False)
    for name in names:
        within = within | ((F.col("lang") == name) & (F.col("_h") <= F.lit(last[name])))
    sample = keyed.where(within).dropDuplicates(["lang", "_h"]).select("lang", F.lower("text").alias("text"))

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for k, lang in enumerate(batch.column(0).to_pylist()):
                piece = data[offsets[k] : offsets[k + 1]]
                grams, _ = gram_buckets(piece, np.array([0, len(piece)]))
                total[lang] = total.get(lang, 0) + np.bincount(grams, minlength=BUCKETS)
        for lang, x in total.items():
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(x[at], pa.int64())], ["lang", "bucket", "n"])

    counted = sample.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((BUCKETS, len(names)))
    for r in counted.collect():  # at most languages x BUCKETS rows
        counts[r["bucket"], names.index(r["lang"])] = r["n"]
    counts += smooth
    return names, np.column_stack([counts / counts.sum(0), np.full(BUCKETS, 1.0 / BUCKETS)])


def with_verdict(docs: DataFrame, model=None, column: str = "_verdict") -> DataFrame:
    """Add the verdict struct of every document; other columns never leave the JVM.

    Null, empty and letterless texts have no trigrams: language ``und``, share 1.0, rejected. Without any labelled
    row every text is ``und``. Equal texts get equal verdicts, and ties of shares keep the order of the names. Very
    long texts are read whole. Short texts are judged like long ones: ``und`` takes part at every length.
    """
    small_batches(docs.sparkSession)
    names, like = model or train(docs)

    @F.arrow_udf(VERDICT)
    def verdict(text: pa.Array) -> pa.Array:
        out = infer(text, names, like)
        release()
        return out

    return spread(docs).withColumn(column, verdict(F.lower("text")))


def identify(docs: DataFrame, model=None) -> DataFrame:
    """One row a document: doc_id, lang, langs, shares, n_grams, rejected.

    Null, empty and letterless texts are ``und``, share 1.0, rejected; so is every text where no row is labelled. Very long
    texts are read whole, repeated rows get the same verdict each, ties of shares keep the order of the names. Null ids
    stay null. An empty table gives no rows. Columns but doc_id, text and lang play no part, whatever their names.
    """
    return with_verdict(docs.select("doc_id", "text", "lang"), model).select("doc_id", "_verdict.*")


def keep_identified(docs: DataFrame, model=None) -> DataFrame:
    """The documents with a recognised language (see ``identify``), all columns unchanged.

    Null, empty and letterless texts go. The working column takes a name that the table has not.
    """
    verdict = unused_name(docs, "_verdict")
    return with_verdict(docs, model, verdict).where(~F.col(verdict)["rejected"]).drop(verdict)
