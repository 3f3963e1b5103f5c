"""A corpus from raw documents to token ids: five stages, each of them one of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textquarry.llm import bpe, decontam, exact_dedup, langid, near_dedup
from textquarry.plans.runtime import drop_shared, shared_tables, write_shared


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is none of those in the corpus go, at every length; so do null, empty and letterless texts.

    Every stage keeps all columns as they are, whatever their names and nulls in them, treats repeated rows and ties as its
    operator says, reads very long texts whole and makes nothing of an empty table.
    """
    return langid.keep_identified(docs)


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, a historical source's first, then the smallest id; null texts stay."""
    return exact_dedup.drop_exact_repeats(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id; null and wordless texts stay."""
    return near_dedup.keep_one(docs)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go, or a short item as a line; null and empty texts stay."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, checked by decoding; null ids for a null text."""
    return bpe.encode_decode(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", remove_exact_copies),
    ("near_dedup", remove_near_copies),
    ("decontamination", remove_benchmark_leaks),
    ("byte_bpe", encode_tokens),
]

#: Mixture inference, SuperMinHash grouping and merge replay have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the table ``documents``; what each returns is written and read again."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        before = len(shared_tables(spark))
        docs = write_shared(stage(spark, docs, sf_dir), name)
        *working, own = shared_tables(spark)[before:]
        drop_shared(spark, [*working, *last])  # nothing reads them any more
        last = [own]
    return STAGES[-1][1](spark, docs, sf_dir)
