from __future__ import annotations

import numpy as np

from textquarry.operators import dedup


def full(hashes):
    a, b = dedup.permutations()
    return [min((((int(h) * int(x) + int(y)) % (1 << 64)) % dedup.PRIME) & dedup.MASK for h in hashes) for x, y in zip(a, b)]


def test_signatures_of_sums_that_wrap():
    """Only the hash of the smallest 32-bit sum is permuted in full, where no other can be smaller."""
    a, b = dedup.permutations()
    draw, edge = np.random.RandomState(2), []
    for x, y in zip(a.tolist(), b.tolist()):
        if x % 2:
            edge += [((u - y) * pow(x, -1, 1 << 32)) % (1 << 32) for u in (*range((1 << 32) - 9, 1 << 32), 0, 1, 7, 8, 9)]
    edge = np.array(edge, np.uint64)
    parts = [edge[k : k + 1] for k in range(0, len(edge), 29)] + [draw.choice(edge, 5) for _ in range(20)] + [draw.randint(0, 1 << 32, n, dtype=np.uint64) for n in (1, 7, 383, 384, 385, 800)]
    assert dedup.signatures_of(parts).tolist() == [full(x) for x in parts]


def test_spelled_band_keys(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(40))), (2, "short"), (3, None)], "doc_id int, norm string")
    for t in dedup.THRESHOLDS:
        (new,) = dedup.band_columns(F.col("norm"), (t,), spelled=True).values()
        rows = df.select(new.alias("new"), dedup.signatures(F.col("norm")).alias("s")).select("new", dedup.bands(F.col("s"), t).alias("old")).collect()
        assert all(r["new"] == r["old"] for r in rows) and rows[0]["new"] and rows[1]["new"] is None
