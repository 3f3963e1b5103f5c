from __future__ import annotations

import random
from collections import Counter

import pytest

from textquarry.operators import grams


@pytest.mark.parametrize("n", [1, 2, 3, 5])
@pytest.mark.parametrize("bucket_bytes", [40, 1 << 20])
def test_gram_counts(spark, n, bucket_bytes):
    """Against plain counting; few packed rows are shuffled, and no table of n-grams is kept."""
    draw = random.Random(6)
    texts = ["", None, " ", "a", "A  b!"] + [" ".join(draw.choice(["a", "b", "\u00c9", "-", "don't", "x" * 30]) for _ in range(draw.randint(0, 30))) for _ in range(150)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    want = Counter()
    for t in texts:
        w = (t or "").lower().replace("-", "").replace("'", "").replace("!", "").replace("\u00e9", "e\u0301").split()
        want.update(" ".join(w[k : k + n]) for k in range(len(w) - n + 1))
    found = grams.gram_counts(df, n, bucket_bytes=bucket_bytes)
    rows = [(r["gram"], r["n"]) for r in found.collect()]
    assert len(rows) == len(want) and dict(rows) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan
