"""Command line: python -m textquarry signals|cluster|exact|tokens|models|classifier ..."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.operators import sampling
from textquarry.plans import jobs
from textquarry.sources import corpus


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="textquarry", description=__doc__)
    p.add_argument("--ledger", help="Parquet table that gets a row for each job")
    todo = p.add_subparsers(dest="job", required=True)
    for name, what in (("signals", "annotate crawl records and compute band keys"), ("exact", "list records whose digest occurred before"), ("tokens", "count tokens")):
        job = todo.add_parser(name, help=what)
        job.add_argument("--input", nargs="+", default=[], help="JSON-line files or folders")
        job.add_argument("--listing", help="file with the shards' paths, one a line")
        job.add_argument("--base", default="", help="folder that the listing's paths start from")
        job.add_argument("--languages", nargs="+", help="languages of the listing to take")
        job.add_argument("--patterns", nargs="+", help="patterns of the listing's paths to take")
        job.add_argument("--max-docs", type=int, default=-1, help="first records to take of each file")
        job.add_argument("--output", required=True)
    job = todo.choices["signals"]
    job.add_argument("--domains", help="folder of block lists, one folder for each category")
    job.add_argument("--categories", nargs="+", help="categories of the block lists to take")
    job.add_argument("--stop-words", help="folder of stop-word lists, one file for each language")
    job.add_argument("--bad-words", help="folder of phrase lists, one file for each language")
    job.add_argument("--models", help="folder written by the job models")
    job.add_argument("--classifier", action="append", default=[], metavar="NAME[@LANGUAGE]=PATH", help="folder written by the job classifier")
    for name in ("signals", "tokens"):
        todo.choices[name].add_argument("--files-per-job", type=int, default=0, help="inputs of one job; others go on where one fails")
    todo.choices["tokens"].add_argument("--tokenizer", help="tokenizer file; words are counted without one")
    job = todo.add_parser("cluster", help="near-duplicate clusters from band keys")
    job.add_argument("--input", nargs="+", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--threshold", type=float, default=0.8, choices=(0.7, 0.8, 0.9, 1.0))
    job.add_argument("--max-docs", type=int, default=-1)
    job = todo.add_parser("models", help="hashed n-gram models of corpora for importance weights")
    job.add_argument("--corpus", action="append", required=True, metavar="NAME=PATH", help="JSON lines with a field text; the name source is the corpus to weigh")
    job.add_argument("--by-language", action="store_true", help="one model for each value of the field lang")
    job.add_argument("--output", required=True)
    job = todo.add_parser("classifier", help="classifier of target corpora against another")
    job.add_argument("--target", nargs="+", required=True, help="JSON lines with a field text")
    job.add_argument("--source", required=True)
    job.add_argument("--language", help="only texts of this value of the field lang")
    job.add_argument("--per-class", type=int, default=75_000)
    job.add_argument("--output", required=True)
    return p


def inputs(spark: SparkSession, a: argparse.Namespace) -> list[str]:
    if not a.listing:
        return a.input
    return [*a.input, *corpus.listed_paths(spark, a.listing, a.base, a.languages, a.patterns)]


def signal_options(spark: SparkSession, a: argparse.Namespace) -> dict:
    from pyspark.ml import PipelineModel

    kw: dict = {"max_docs": a.max_docs}
    if a.domains:
        pairs = corpus.read_lists(spark, a.domains)
        if a.categories:
            pairs = pairs.where(F.col("category").isin(a.categories))
        names = a.categories or [r["category"] for r in pairs.select("category").distinct().collect()]
        index = spark.createDataFrame(sampling.category_sets(names), "category_id int, categories array<string>")
        kw["domains"] = sampling.domain_categories(pairs, index)
    for key, folder in (("stop_words", a.stop_words), ("bad_words", a.bad_words)):
        if folder:
            kw[key] = corpus.read_phrase_lists(spark, folder)
    if a.models:
        kw |= {k: spark.read.parquet(f"{a.models}/{k}") for k in ("models", "rates")}
    for name, path in (x.split("=", 1) for x in a.classifier):
        name, _, lang = name.partition("@")
        kw.setdefault("classifiers", {})[(lang, name) if lang else name] = PipelineModel.load(path)
    return kw


def texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("text string, lang string").json(path)


def write_tokens(spark: SparkSession, paths: list[str], a: argparse.Namespace) -> None:
    corpus.write_parquet(jobs.token_records(corpus.read_jsonl(spark, paths, max_samples=a.max_docs), a.tokenizer), a.output, "snapshot_id", "append")


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.job in ("signals", "tokens"):
        if a.job == "signals":
            kw = signal_options(spark, a)
            job = lambda paths: jobs.write_signals(spark, paths, a.output, **kw)
        else:
            job = lambda paths: write_tokens(spark, paths, a)
        failed = jobs.isolated(spark, a.ledger, a.job, inputs(spark, a), job, a.files_per_job)
        if failed:
            raise SystemExit(f"failed: {' '.join(failed)}")
    elif a.job == "exact":
        corpus.write_parquet(jobs.exact_duplicate_records(corpus.read_jsonl(spark, inputs(spark, a), max_samples=a.max_docs)), a.output, "snapshot_id")
    elif a.job == "cluster":
        corpus.write_parquet(jobs.cluster_records(spark.read.parquet(*a.input), a.threshold, a.max_docs), a.output, "shard_id")
        spark.read.parquet(a.output).orderBy("cluster_id", "id").show(20, truncate=False)
    elif a.job == "classifier":
        own = lambda path: texts(spark, path).where(F.col("lang") == a.language) if a.language else texts(spark, path)
        jobs.write_classifier([own(t) for t in a.target], own(a.source), a.output, a.per_class)
    else:
        tables = {name: texts(spark, path) for name, path in (x.split("=", 1) for x in a.corpus)}
        for table, name in zip(jobs.prepare_models(tables, "lang" if a.by_language else None), ("models", "rates")):
            table.write.parquet(f"{a.output}/{name}")


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"textquarry {a.job}").getOrCreate()
    if a.job in ("signals", "tokens"):  # these keep a row for each group of inputs
        run(spark, a)
    else:
        jobs.audited(spark, a.ledger, a.job, lambda: run(spark, a))


if __name__ == "__main__":
    main()
