from __future__ import annotations

import pytest

from compare import oracle_rows, spark_rows
from textquarry import queries as core

SQL = core.oracle_sql()


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_query(spark, sf_dir, name):
    names, rows = spark_rows(core.queries()[name](spark, sf_dir))
    if name in SQL:
        assert (names, rows) == oracle_rows(sf_dir, SQL[name])
    else:
        assert rows


def test_long_signals_round_ties_as_their_sql(spark, tmp_path):
    # 32 / 127 = 0.25196850 and 17 / 127 = 0.13385827 to eight digits: the first is a tie at six, the second is none
    texts = ["{" * 32 + "a" * 95, "{" * 17 + "a" * 110, "A" * 32 + "b" * 94 + "\n" + "B" * 17 + "c" * 110, "", "{}"]
    texts += ["{" * k + "a" * (n - k) for n in (127, 254, 508) for k in range(1, n, 31)]
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").toPandas().to_parquet(tmp_path / "documents.parquet")
    names, got = spark_rows(core.queries()["quality_signals_long"](spark, str(tmp_path)))
    assert (names, got) == oracle_rows(str(tmp_path), SQL["quality_signals_long"])
    assert ("0", "127", "0.251968", "'rps_doc_curly_bracket'", "0") in got


def test_every_oracle_has_its_query():
    assert set(SQL) <= set(core.queries())


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).columns == ["doc_id", "cluster_id", "shard_id"]
    assert set(driver.oracle_sql()) <= set(driver.queries())
