from __future__ import annotations

import corpus_pipeline
import pytest
from compare import oracle_rows, spark_rows
from pyspark.sql import functions as F

from textquarry.llm import bpe, decontam, exact_dedup, langid, near_dedup
from textquarry.llm import queries as llm

SQL = llm.oracle_sql()


@pytest.mark.parametrize("name", sorted(llm.queries()))
def test_query(spark, sf_dir, name):
    names, rows = spark_rows(llm.queries()[name](spark, sf_dir))
    if name in SQL:
        assert (names, rows) == oracle_rows(sf_dir, SQL[name])
    else:
        assert rows or name == "op10_secret_scan"


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns, name
        docs = docs.cache()
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.7 * counts[0]
    left = docs.count()
    assert exact_dedup.exact_repeats(docs).count() == near_dedup.near_duplicates(docs).count() == 0
    assert decontam.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).count() == 0
    assert langid.identify(docs).where("rejected").count() <= 0.01 * left + 1
    encoded = corpus_pipeline.run(spark, sf_dir)
    assert encoded.count() == left and encoded.where("NOT decoded_ok").count() == 0
    assert encoded.columns == bpe.encode_decode(docs.limit(0)).columns


def test_stages_keep_odd_rows_and_columns(spark, sf_dir, tmp_path):
    """Nulls in every column, empty, long and repeated texts, and columns named like the operators' own, from several files."""
    own = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = [(None, None, None, None, None), (None, "", "en", None, 1), (1, None, "en", "s", None), (9001, "z" * 300_000 + " end", None, "s", None), (9002, "the same " * 40, "en", "s", 1), (9002, "the same " * 40, "en", "s", 1), (None, "the same " * 40, "en", "s", 1), (None, "...", None, None, None)]
    docs = own.unionByName(spark.createDataFrame(odd, own.schema))
    extra = ("a.b", "_rid", "_old", "_hits", "_verdict", "key", "set", "h", "win", "Shard")
    for name in extra:
        docs = docs.withColumn(name, F.lit(name))
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns, name
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.where(" AND ".join(f"`{c}` = '{c}'" for c in extra)).count() == docs.count(), name
        if name != "language_id":
            assert docs.where("text LIKE 'the same%'").count() == 1, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count() and last.where("NOT decoded_ok").count() == 0


def test_stages_on_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
