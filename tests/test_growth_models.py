from __future__ import annotations

import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textquarry.operators import importance


def test_md5_of_whole_arrays():
    grams = ["x" * n + tail for n in range(130) for tail in ("", "\u00e9", " \u6f22")] * 12
    want = [int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % 10_000 for g in grams]
    assert importance._hashed(pa.array(grams, pa.large_string()), 10_000).tolist() == want
    assert importance._hashed(pa.array([], pa.large_string()), 10_000).tolist() == []


def test_sizes_come_with_the_model(spark):
    df = spark.createDataFrame([("a b", "x"), (None, "x"), ("", "x"), ("c!", None)], "text string, part string")
    found = {(r["part"], r["bucket"]): r["cnt"] for r in importance.ngram_model(df, by="part", sizes=True).collect()}
    n = importance.BUCKETS
    assert (found["x", n], found["x", n + 1], found[None, n], found[None, n + 1]) == (2, 2, 1, 2)
    assert all(b < n for (b,) in importance.ngram_model(df).select("bucket").collect())


@pytest.mark.parametrize("n", [0, 1, 5, 6, 40, 41, 100])
def test_training_rows_are_chosen_by_their_numbers(spark, n):
    """No text is sorted or cut off in one task, and ties are cut as a sort would cut them."""
    df = spark.createDataFrame([(k, k // 4, f"t{k}") for k in range(41)], "id bigint, k bigint, text string").repartition(3)
    rows = importance._first(df, n, F.col("k"))
    got = rows.collect()
    assert sorted(r["k"] for r in got) == sorted(r["k"] for r in df.collect())[:n] and len({r["id"] for r in got}) == len(got)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Sort" not in plan
