"""Whole jobs over crawl records: annotate, cluster, find exact duplicates, count tokens, prepare models."""

from __future__ import annotations

import time
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.functions import text as X
from textquarry.operators import dedup, importance, sampling, signals
from textquarry.plans.runtime import join_checked, write_shared
from textquarry.sources import corpus

CORPUS_COLUMNS = {"ccnet_length": "length", "ccnet_original_length": "original_length", "ccnet_nlines": "nlines", "ccnet_original_nlines": "original_nlines", "ccnet_language_score": "language_score", "ccnet_perplexity": "perplexity"}


LEDGER = "job string, input string, status string, n_records bigint, seconds double, error string"


def audited(spark: SparkSession, ledger: str | None, job: str, run: Callable[[], int | None], inputs: str | None = None) -> None:
    """Run a job and add a row to the ledger table: job, input, status, number of records, seconds, error."""
    began, status, error, n = time.time(), "SUCCESS", None, None
    try:
        n = run()
    except Exception as e:
        status, error = "FAIL", str(e)[:2000]
        raise
    finally:
        if ledger:
            spark.createDataFrame([(job, inputs, status, n, time.time() - began, error)], LEDGER).write.mode("append").parquet(ledger)


def isolated(spark: SparkSession, ledger: str | None, job: str, paths: list[str], run: Callable[[list[str]], int | None], per_job: int = 0) -> list[str]:
    """Run a job over groups of ``per_job`` inputs (0: all in one), each with a ledger row; the inputs of groups that failed.

    A group that fails doesn't stop the others: a broken file costs its own group alone.
    """
    failed = []
    size = per_job or len(paths) or 1
    for k in range(0, len(paths), size):
        group = paths[k : k + size]
        try:
            audited(spark, ledger, job, lambda group=group: run(group), ",".join(group)[:2000])
        except Exception:
            if size >= len(paths):
                raise
            failed += group
    return failed


def with_importance(rows: DataFrame, models: DataFrame, rates: DataFrame, source: str = "source", unit: str = "chars", text: str = "text", lang: str | None = None) -> tuple[DataFrame, list[str]]:
    """``rows`` with two columns for each target corpus, ``rps_doc_<name>_importance`` and ``..._length_correction``, and their names.

    ``models``: corpus, bucket, cnt; ``rates``: corpus, lambda; both may have a ``language``, and documents are then
    weighed with the models of theirs, those of other languages not at all. ``unit`` is what the length correction
    counts: ``chars`` as a rule, or ``words``, the unit of the rates. A document without words has no importance. Only
    the models, BUCKETS rows a corpus and language, reach the driver.
    """
    by = lang is not None and "language" in models.columns
    key = (lambda r: r["language"]) if by else (lambda r: None)
    held: dict = {}
    for r in models.collect():
        table = held.setdefault((key(r), r["corpus"]), np.zeros(importance.BUCKETS))
        table[r["bucket"]] += r["cnt"]
    rate = {(key(r), r["corpus"]): r["lambda"] for r in rates.collect()}
    names, langs = sorted({c for _, c in held} - {source}), sorted({x for x, _ in held}, key=str)
    share = lambda t: t / max(t.sum(), 1.0)
    ln = lambda p: np.log(p + importance.FLOOR)
    pairs = [(x, c) for x in langs for c in names if (x, c) in held and (x, source) in held]
    if not pairs:
        return rows, []
    tables = np.stack([ln(share(held[p])) - ln(share(held[p[0], source])) for p in pairs])
    sums = importance.gram_sums(F.col(text), tables)
    n = F.length(text) if unit == "chars" else F.size(X.raw_words(F.col(text)))
    rows = rows.withColumns({"_sums": sums, "_size": n})
    found = {}
    for c in names:
        plain, corrected = F.lit(None).cast("double"), F.lit(None).cast("double")
        for k, (x, name) in enumerate(pairs):
            if name == c:
                own = F.lit(True) if x is None else F.col(lang) == x
                weight = F.col("_sums")[k]
                plain = F.when(own, weight).otherwise(plain)
                corrected = F.when(own, weight + importance.length_correction(F.col("_size"), F.lit(rate[x, c]), F.lit(rate[x, source]))).otherwise(corrected)
        found |= {f"rps_doc_{c}_importance": X.score(plain), f"rps_doc_{c}_importance_length_correction": X.score(corrected)}
    return rows.withColumns(found).drop("_sums", "_size"), list(found)


def annotate_records(records: DataFrame, domains: DataFrame | None = None, models: DataFrame | None = None, rates: DataFrame | None = None, classifiers: dict | None = None, stop_words: dict[str, list[str]] | None = None, bad_words: dict[str, list[str]] | None = None, keep_bands: bool = False) -> DataFrame:
    """Signals of crawl records (see ``corpus.read_jsonl``): block-list category, importance and classifier scores if given.

    ``domains``: domain, category_id. ``classifiers``: signal name -> fitted model, or a pair of language and signal
    name -> fitted model. All scores are computed beside the record: no text is shuffled. ``keep_bands``
    adds the columns of ``minhash_records``.
    """
    rows = records.withColumn("text", F.coalesce("raw_content", F.lit("")))
    extra: dict[str, Column] = {}
    if domains is not None:
        known = domains.select(F.col("domain").alias("source_domain"), F.col("category_id").alias("_category"))
        rows = join_checked(rows, known, "source_domain", "left", 64)
        extra["rps_doc_ut1_blacklist"] = F.col("_category")
    if models is not None and rates is not None:
        rows, names = with_importance(rows, models, rates, lang="language")
        extra |= {c: F.col(c) for c in names}
    for k, (name, model) in enumerate(sorted((classifiers or {}).items(), key=str)):
        lang, name = name if isinstance(name, tuple) else (None, name)
        rows = importance.with_classifier(model, rows, f"_clf{k}")
        score = F.col(f"_clf{k}") if lang is None else F.when(F.col("language") == lang, F.col(f"_clf{k}"))
        extra[name] = F.coalesce(extra[name], score) if name in extra else score
    keep = dedup.band_columns(F.col("_norm")) if keep_bands else {}
    return signals.annotate(rows, "idx", "uri_id", "text", "language", extra, signals.passthrough(rows, CORPUS_COLUMNS, "bucket"), stop_words, bad_words, keep)


def minhash_records(records: DataFrame, thresholds: tuple[float, ...] = dedup.THRESHOLDS) -> DataFrame:
    """shard_id, id, id_int and one column of band keys for each threshold."""
    doc_id = F.concat_ws("/", "uri_id", F.col("idx").cast("string"))
    rows = records.select(F.col("uri_id").alias("shard_id"), doc_id.alias("id"), X.doc_id_hash(doc_id).alias("id_int"), X.normalize(F.coalesce("raw_content", F.lit(""))).alias("_norm"))
    return dedup.minhash_rows(rows, F.col("_norm"), thresholds).drop("_norm")


def cluster_records(minhash: DataFrame, threshold: float, max_docs: int = -1) -> DataFrame:
    """id, id_int, cluster_id, shard_id of all records that share a band with another."""
    column = f"`signature_sim{threshold}`"
    rows = minhash.orderBy("id_int").limit(max_docs) if max_docs > 0 else minhash
    keyed = rows.select("id", "id_int", "shard_id", dedup.signed(F.col("id_int")).alias("node"), F.transform(column, F.hex).alias("keys"))
    found = dedup.clusters(dedup.lsh_edges(keyed, "node", "keys"))
    labelled = dedup.attach_clusters(keyed.select("id", "id_int", "shard_id", "node"), found, "node")
    return labelled.select("id", F.col("id_int").cast("decimal(20,0)").alias("id_int"), dedup.unsigned(F.col("cluster_id")).alias("cluster_id"), "shard_id")


def exact_duplicate_records(records: DataFrame) -> DataFrame:
    """shard_id, doc_id, digest, snapshot_id of all repeats, newest snapshots first, then by shard and line."""
    doc_id = F.concat_ws("/", "uri_id", F.col("idx").cast("string")).alias("doc_id")
    named = records.select(F.col("uri_id").alias("shard_id"), doc_id, F.regexp_replace("digest", "^sha1:", "").alias("digest"), "snapshot_id", "idx")
    return dedup.repeats_of(named, "snapshot_id", ["shard_id", "idx"]).select("shard_id", "doc_id", "digest", "snapshot_id")


def token_records(records: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """input_id, doc_id, snapshot_id, num_tokens; words are counted where no tokenizer file is given."""
    text = F.coalesce("raw_content", F.lit(""))
    n = sampling.pretrained_token_count(text, tokenizer) if tokenizer else sampling.word_token_count(text)
    return records.select(F.col("uri_id").alias("input_id"), F.concat_ws("/", "uri_id", F.col("idx").cast("string")).alias("doc_id"), "snapshot_id", n.alias("num_tokens"))


def prepare_models(corpora: dict[str, DataFrame], by: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Models (corpus, bucket, cnt) and rates (corpus, lambda) of corpora that have a text; for each ``language`` where ``by`` names that column."""
    models = rates = None
    own = [F.col(by).alias("language")] if by else []
    for name, docs in sorted(corpora.items()):
        m = importance.ngram_model(docs, by=by).select(F.lit(name).alias("corpus"), *own, "bucket", "cnt")
        r = importance.mean_words(docs, by=by).select(F.lit(name).alias("corpus"), *own, "lambda")
        models, rates = (m, r) if models is None else (models.unionByName(m), rates.unionByName(r))
    return models, rates


def write_classifier(targets: list[DataFrame], rest: DataFrame, path: str, per_class: int = 75_000) -> None:
    """Train a classifier of the target corpora against the rest, on ``per_class`` rows of each at most, and save it.

    Rows are chosen by the hashes of their texts.
    """
    flat = lambda x: x.where("text IS NOT NULL").select(X.classifier_text(F.col("text")).alias("text"))
    rows = importance.balanced([flat(t) for t in targets], flat(rest), per_class, F.xxhash64("text"))
    importance.train_classifier(rows).write().overwrite().save(path)


def write_signals(spark: SparkSession, paths: list[str], out: str, max_docs: int = -1, **kw) -> int:
    """Signals as gzipped JSON lines and band keys as Parquet, a folder for each shard; the number of records.

    Texts are read once: what both outputs take of them is written to the shared folder in one pass.
    """
    records = corpus.read_jsonl(spark, paths, max_samples=max_docs)
    both = write_shared(annotate_records(records, keep_bands=True, **kw), "annotated")
    shard = F.col("metadata.shard_id").alias("shard")
    corpus.write_jsonl(both.select("id", "id_int", "metadata", "quality_signals", shard), f"{out}/signals", "shard", "append")
    bands = [F.col(f"`signature_sim{t}`") for t in dedup.THRESHOLDS]
    corpus.write_parquet(both.select(F.col("metadata.shard_id").alias("shard_id"), "id", "id_int", *bands), f"{out}/minhash", "shard_id", "append")
    return both.count()
