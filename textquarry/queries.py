"""Standing queries of the corpus operators and their DuckDB oracles. Every one reads its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.functions import text as X
from textquarry.functions.lexicons import BAD_WORDS, CATEGORIES, DOMAIN_CATEGORIES
from textquarry.operators import dedup, grams, importance, sampling, signals
from textquarry.oracles import oracle_sql as oracle_sql
from textquarry.plans.runtime import session_dir, small_batches, spread, write_shared
from textquarry.sources import corpus

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
CLUSTER_THRESHOLD = 0.7
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def spread_docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The documents' columns, over all cores even where their file is one row group."""
    small_batches(spark)
    return spread(docs(spark, sf_dir).select(*columns))


def _bucket(c: Column) -> Column:
    return F.when(c % 3 == 0, "head").when(c % 3 == 1, "middle").otherwise("tail")


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of crawl shards made from the documents' ids."""
    week, shard = F.lpad((1 + F.col("doc_id") % 50).cast("string"), 2, "0"), F.lpad((F.col("doc_id") % 7).cast("string"), 4, "0")
    path = F.concat(F.lit("2023-"), week, F.lit("/"), shard, F.lit("/"), F.col("lang"), F.lit("_"), _bucket(F.col("doc_id")), F.lit(".json.gz"))
    return docs(spark, sf_dir).select("doc_id", path.alias("path"))


@query
def scan_limit(spark, sf_dir):
    return sampling.first_n(docs(spark, sf_dir).select("doc_id", "n_chars"), 25, ["doc_id"])


@query
def source_pruning(spark, sf_dir):
    return corpus.pruned(_paths(spark, sf_dir), ["en", "de"], [r".*/[a-z]{2}_(head|middle)\.json\.gz"])


@query
def head_middle_listing(spark, sf_dir):
    return corpus.head_middle(_paths(spark, sf_dir))


@query
def token_listing(spark, sf_dir):
    paths = _paths(spark, sf_dir)
    return corpus.parsed_listing(paths, "2023-11").join(paths, "path").distinct().select("doc_id", "path", "snapshot_id", "shard_id", "lang_bucket")


@query
def snapshot_extract(spark, sf_dir):
    return _paths(spark, sf_dir).select("doc_id", X.snapshot_of(F.col("path")).alias("snapshot_id"), X.uri_id_of(F.col("path")).alias("uri_id"))


@query
def bucket_code(spark, sf_dir):
    name = F.when(F.col("doc_id") % 4 == 3, "other").otherwise(F.element_at(F.array(*map(F.lit, ("head", "middle", "tail", "other"))), (F.col("doc_id") % 4 + 1).cast("int")))
    return docs(spark, sf_dir).select("doc_id", X.bucket_code(name).alias("score"))


def _sink(spark, name: str) -> str:
    return f"{session_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def jsonl_round_trip(spark, sf_dir):
    """Crawl records written as gzipped JSON lines, a folder for each shard, and read back."""
    rows = docs(spark, sf_dir).select(F.col("text").alias("raw_content"), F.col("lang").alias("language"), F.col("n_chars").alias("length"), F.col("doc_id").cast("string").alias("digest"), F.col("source").alias("shard"))
    corpus.write_jsonl(rows, path := _sink(spark, "records"), "shard")
    back = corpus.read_jsonl(spark, f"{path}/*")
    return back.select(F.col("digest").cast("bigint").alias("doc_id"), F.sha1("raw_content").alias("text_hash"), "language", "length")


@query
def partition_by_shard(spark, sf_dir):
    """The table written as Parquet, a folder for each shard, and counted by folder."""
    rows = docs(spark, sf_dir).select("doc_id", "n_chars", F.col("source").alias("shard_id"))
    corpus.write_parquet(rows, path := _sink(spark, "shards"), "shard_id")
    return corpus.read_parquet(spark, [path], rows.schema).groupBy("shard_id").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars"))


def _norm() -> Column:
    return X.normalize(F.coalesce("text", F.lit("")))


def _words(spark, sf_dir) -> DataFrame:
    return spread_docs(spark, sf_dir, "doc_id", "lang", "text").select("doc_id", "lang", _norm().alias("norm")).select("doc_id", "lang", X.norm_words(F.col("norm")).alias("w"))


@query
def text_normalize(spark, sf_dir):
    return spread_docs(spark, sf_dir, "doc_id", "text").select("doc_id", _norm().alias("norm"))


@query
def norm_words(spark, sf_dir):
    return _words(spark, sf_dir).select("doc_id", F.size("w").cast("bigint").alias("n"), F.array_join("w", "|").alias("words"))


@query
def raw_words(spark, sf_dir):
    rows = spread_docs(spark, sf_dir, "doc_id", "text").select("doc_id", X.raw_words(F.col("text")).alias("w"))
    return rows.select("doc_id", F.size("w").cast("bigint").alias("n"), F.array_join("w", "|").alias("words"))


@query
def explode_words(spark, sf_dir):
    return _words(spark, sf_dir).select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def _gram_counts(n: int) -> Query:
    return lambda spark, sf_dir: grams.gram_counts(spread_docs(spark, sf_dir, "text"), n)


_QUERIES |= {"ngrams_2": _gram_counts(2), "ngrams_3": _gram_counts(3)}


def _by_line(rows: DataFrame, lines: Column) -> DataFrame:
    """doc_id, line_no, x for every line; the outer form keeps Spark from computing the lines once more as a filter."""
    return rows.select("doc_id", F.posexplode_outer(lines).alias("line_no", "x")).where("line_no IS NOT NULL")


@query
def split_lines(spark, sf_dir):
    rows = _by_line(spread_docs(spark, sf_dir, "doc_id", "text"), X.line_spans(F.col("text")))
    return rows.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), F.col("x.start").cast("bigint").alias("start_pos"), F.col("x.end").cast("bigint").alias("end_pos"), F.col("x.text").alias("line"))


@query
def paragraphs_nonempty(spark, sf_dir):
    return split_lines(spark, sf_dir).where(X.trim_space(F.col("line")) != "")


@query
def classifier_text(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", X.classifier_text(F.col("text")).alias("flat"))


@query
def text_span(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", X.text_span(F.col("text"), 2, 20).alias("span"))


@query
def sha1_hash32(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", X.sha1_hash32(F.col("text")).alias("h"))


@query
def doc_id_hash(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", X.doc_id_hash(F.concat_ws("/", "source", F.col("doc_id").cast("string"))).cast("string").alias("id_int"))


def _category_index(spark) -> DataFrame:
    return spark.createDataFrame(sampling.category_sets(CATEGORIES), "category_id int, categories array<string>")


@query
def category_index(spark, sf_dir):
    return _category_index(spark).select("category_id", F.array_join("categories", ",").alias("categories"))


def _domains(spark) -> DataFrame:
    return sampling.domain_categories(spark.createDataFrame(DOMAIN_CATEGORIES, "domain string, category string"), _category_index(spark))


@query
def domain_categories(spark, sf_dir):
    return _domains(spark).select("domain", F.array_join("categories", ",").alias("categories"))


@query
def sig_passthrough(spark, sf_dir):
    rows = docs(spark, sf_dir).withColumn("_nlines", F.size(X.lines(F.col("text"))))
    found = signals.passthrough(rows, {"ccnet_length": "n_chars", "ccnet_nlines": "_nlines"})
    return rows.select("doc_id", *[found[k].alias(k) for k in ("ccnet_length", "ccnet_nlines")])


def _doc_signal(name: str, digits: int | None = None) -> Query:
    def run(spark, sf_dir):
        c = signals.DOC_SIGNALS[name]()
        return signals.prepared(spread_docs(spark, sf_dir, "doc_id", "text", "lang")).select("doc_id", (F.round(c, digits) + F.lit(0.0) if digits else c).alias("score"))

    return run


_QUERIES |= {name: _doc_signal(name, 6 if name.endswith("entropy") else None) for name in signals.DOC_SIGNALS}


def _line_signal(name: str) -> Query:
    def run(spark, sf_dir):
        rows = signals.prepared(spread_docs(spark, sf_dir, "doc_id", "text", "lang"))
        return _by_line(rows, signals.line_scores(name)).select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), F.col("x.start").cast("bigint").alias("start_pos"), F.col("x.end").cast("bigint").alias("end_pos"), F.col("x.score").alias("score"))

    return run


_QUERIES |= {name: _line_signal(name) for name in signals.MEASURED}


@query
def curly_brackets_in_pages(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").withColumn("_text", F.col("html"))
    return rows.select("page_id", signals.DOC_SIGNALS["rps_doc_curly_bracket"]().alias("score"))


@query
def badword_semi_join(spark, sf_dir):
    phrases = spark.createDataFrame([(k, p) for k, v in BAD_WORDS.items() for p in v], "lang string, phrase string")
    words = _words(spark, sf_dir)
    found = words.select("doc_id", "lang", F.explode(F.concat("w", X.ngrams(F.col("w"), 2))).alias("phrase"))
    hits = found.join(F.broadcast(phrases), ["lang", "phrase"], "left_semi").groupBy("doc_id").agg(F.count("*").alias("hits"))
    return words.select("doc_id").join(hits, "doc_id", "left").select("doc_id", F.coalesce("hits", F.lit(0).cast("bigint")).alias("hits"))


@query
def blacklist_left_join(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1).alias("domain"))
    return pages.join(F.broadcast(_domains(spark)), "domain", "left").select("page_id", "domain", F.array_join("categories", ",").alias("categories"))


@query
def rps_doc_ut1_blacklist(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1).alias("domain"))
    return pages.join(F.broadcast(_domains(spark)), "domain", "left").select("page_id", "domain", F.col("category_id").cast("double").alias("score"))


@query
def quality_signals(spark, sf_dir):
    """The whole annotated record of every document."""
    rows = spread_docs(spark, sf_dir, "doc_id", "source", "text", "lang", "n_chars").withColumn("_nl", F.size(X.lines(F.col("text"))))
    return signals.annotate(rows, "doc_id", "source", corpus=signals.passthrough(rows, {"ccnet_length": "n_chars", "ccnet_nlines": "_nl"}))


def _rounded(c: Column, digits: int) -> Column:
    """The double scaled up, rounded half away from zero and scaled down, as DuckDB does it; F.round rounds its decimal spelling, which takes other ties up."""
    return F.round(c * F.lit(10.0**digits)) / F.lit(10.0**digits)


@query
def quality_signals_long(spark, sf_dir):
    """Every number of the annotated records: doc_id, signal, start_pos, end_pos, score."""
    names = [*signals.DOC_SIGNALS, *signals.MEASURED]
    rows = signals.all_line_scores(signals.prepared(spread_docs(spark, sf_dir, "doc_id", "text", "lang")))
    whole = lambda c: F.array(F.struct(F.lit(0).alias("start"), F.length("_text").alias("end"), c.cast("double").alias("score")))
    each = F.array(*[F.struct(F.lit(n).alias("signal"), (whole(signals.DOC_SIGNALS[n]()) if n in signals.DOC_SIGNALS else F.col(n).cast(signals.SPAN)).alias("spans")) for n in names])
    found = rows.select("doc_id", F.explode(each).alias("s")).select("doc_id", "s.signal", F.explode("s.spans").alias("x"))
    return found.select("doc_id", "signal", F.col("x.start").cast("bigint").alias("start_pos"), F.col("x.end").cast("bigint").alias("end_pos"), (_rounded(F.col("x.score"), 6) + F.lit(0.0)).alias("score"))


@query
def linear_score(spark, sf_dir):
    weights = spark.range(importance.BUCKETS).select(F.col("id").cast("int").alias("bucket"), (((F.col("id") * 7919) % 2001 - 1000) / 1000.0).alias("weight"))
    return importance.linear_score(spread_docs(spark, sf_dir, "doc_id", "text"), weights).select("doc_id", F.round("score", 6).alias("score"))


@query
def ml_quality_score(spark, sf_dir):
    """Probability of good quality under a classifier trained on the labelled documents (at most 75,000 a class)."""
    rows, marks = docs(spark, sf_dir), table(spark, sf_dir, "labels").select("doc_id", "quality")
    labelled = rows.where("text IS NOT NULL").join(marks, "doc_id").select("doc_id", X.classifier_text(F.col("text")).alias("text"), "quality")
    part = lambda y: labelled.where(F.col("quality") == y).select("doc_id", "text")
    train = importance.balanced([part(1)], part(0), 75_000, F.xxhash64("doc_id"))
    return importance.classifier_scores(importance.train_classifier(train), rows)


@query
def hash_features(spark, sf_dir):
    return importance.hash_features(spread_docs(spark, sf_dir, "doc_id", "text"))


@query
def dsir_counts(spark, sf_dir):
    return importance.ngram_model(spread_docs(spark, sf_dir, "doc_id", "text"))


@query
def dsir_lambda(spark, sf_dir):
    return importance.mean_words(docs(spark, sf_dir)).select(F.round("lambda", 6).alias("lambda"))


def _counts(spark, sf_dir, sizes: bool = False) -> DataFrame:
    """part, bucket, cnt: one pass counts the target, part ``good``, and the rest."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id", F.lit("good").alias("part")).distinct()
    rows = spread_docs(spark, sf_dir, "doc_id", "text").join(good, "doc_id", "left")
    return write_shared(importance.ngram_model(rows, by="part", sizes=sizes), "counts")


def _importance(spark, sf_dir, counts: DataFrame) -> DataFrame:
    # the source model is both parts
    target, source = counts.where("part = 'good'").select("bucket", "cnt"), counts.groupBy("bucket").agg(F.sum("cnt").alias("cnt"))
    return importance.importance(spread_docs(spark, sf_dir, "doc_id", "text"), importance.log_ratios(target, source))


@query
def importance_weight(spark, sf_dir):
    return _importance(spark, sf_dir, _counts(spark, sf_dir)).select("doc_id", F.round("importance", 4).alias("importance"))


@query
def importance_length_correction(spark, sf_dir):
    counts = _counts(spark, sf_dir, sizes=True)
    n, texts = F.col("bucket"), F.lit(importance.BUCKETS)
    total = lambda k, part: F.sum(F.when((n == texts + k) & part, F.col("cnt")))
    good = F.coalesce(F.col("part") == "good", F.lit(False))
    sizes = counts.where(n >= texts).agg(*[(total(1, p) / total(0, p)).alias(name) for name, p in (("target", good), ("rest", F.lit(True)))]).first()
    correction = importance.length_correction(F.col("n_chars"), F.lit(sizes["target"]), F.lit(sizes["rest"]))
    weights = _importance(spark, sf_dir, counts.where(n < texts))
    return docs(spark, sf_dir).join(weights, "doc_id").select("doc_id", F.round(F.col("importance") + correction, 4).alias("importance"))


@query
def token_count(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", sampling.word_token_count(F.col("text")).alias("num_tokens"))


@query
def token_totals(spark, sf_dir):
    rows = spread_docs(spark, sf_dir, "lang", "source", "text").select("lang", "source", sampling.word_token_count(F.col("text")).alias("n"))
    return rows.groupBy("lang", "source").agg(F.count("*").alias("n_docs"), F.sum("n").alias("num_tokens"))


@query
def token_count_pretrained(spark, sf_dir):
    return spread_docs(spark, sf_dir, "doc_id", "text").select("doc_id", sampling.pretrained_token_count(F.col("text"), TOKENIZER).alias("num_tokens"))


@query
def seeded_shuffle(spark, sf_dir):
    return sampling.shuffled(docs(spark, sf_dir).select("doc_id"), 42, ["doc_id"], key="shuffle_key")


@query
def stratified_sample(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", "source", _bucket(F.col("doc_id")).alias("bucket"))
    return sampling.stratified(rows, 400, "source", "bucket", ["doc_id"])


@query
def chunk_paragraphs(spark, sf_dir):
    return sampling.chunks(docs(spark, sf_dir).select("doc_id", "text"), 3, 20).select("doc_id", "chunk", "chunk_text")


def _exact(spark, sf_dir) -> DataFrame:
    return dedup.exact_duplicates(docs(spark, sf_dir), "source", "doc_id", F.sha1("text"))


@query
def exact_dup(spark, sf_dir):
    return _exact(spark, sf_dir)


@query
def dup_stats_by_source(spark, sf_dir):
    return dedup.duplicate_counts(_exact(spark, sf_dir))


@query
def lsh_parameters(spark, sf_dir):
    return spark.createDataFrame([(t, *dedup.optimal_bands(t)) for t in dedup.THRESHOLDS], "threshold double, bands int, rows int")


@query
def minhash_min_k(spark, sf_dir):
    """All slots of every signature."""
    rows = spread_docs(spark, sf_dir, "doc_id", "text").select("doc_id", dedup.signatures(_norm()).alias("s"))
    return rows.select("doc_id", F.posexplode_outer("s").alias("perm", "min_hash")).where("perm IS NOT NULL")


def _keyed(spark, sf_dir, thresholds: tuple[float, ...], spelled: bool) -> DataFrame:
    """doc_id and the band keys at each threshold, t0, t1, ..."""
    columns = dedup.band_columns(_norm(), thresholds, spelled=spelled).values()
    return spread_docs(spark, sf_dir, "doc_id", "text").select("doc_id", *[c.alias(f"t{k}") for k, c in enumerate(columns)])


def _banded(spark, sf_dir) -> DataFrame:
    return write_shared(_keyed(spark, sf_dir, (CLUSTER_THRESHOLD,), False).select("doc_id", F.col("t0").alias("keys")), "bands")


@query
def minhash_bands(spark, sf_dir):
    return _keyed(spark, sf_dir, (CLUSTER_THRESHOLD,), True).select("doc_id", F.posexplode_outer("t0").alias("band", "key")).where("band IS NOT NULL")


@query
def minhash_bands_all(spark, sf_dir):
    """Band keys at all four thresholds."""
    rows = _keyed(spark, sf_dir, dedup.THRESHOLDS, True)
    each = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{k}").alias("keys")) for k, t in enumerate(dedup.THRESHOLDS)])
    return rows.select("doc_id", F.explode(each).alias("t")).select("doc_id", "t.threshold", F.posexplode_outer("t.keys").alias("band", "key")).where("band IS NOT NULL")


@query
def lsh_edges(spark, sf_dir):
    return dedup.lsh_edges(_banded(spark, sf_dir), "doc_id", "keys")


def _clusters(spark, sf_dir) -> DataFrame:
    return dedup.clusters(dedup.lsh_edges(_banded(spark, sf_dir), "doc_id", "keys"))


@query
def connected_components(spark, sf_dir):
    return _clusters(spark, sf_dir)


@query
def dup_clusters(spark, sf_dir):
    return dedup.attach_clusters(docs(spark, sf_dir).select("doc_id", F.col("source").alias("shard_id")), _clusters(spark, sf_dir), "doc_id").select("doc_id", "cluster_id", "shard_id")


@query
def topk_clusters(spark, sf_dir):
    return dup_clusters(spark, sf_dir).orderBy("cluster_id", "doc_id").limit(20).select("cluster_id", "doc_id")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
