"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.plans.runtime import write_shared

#: One union-find works on about this many edges; 16 bytes each.
EDGES_PER_TASK = 2_000_000


def union_find(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes and the smallest node of each one's component."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    half = len(left)
    for a, b in zip(at[:half].tolist(), at[half:].tolist()):
        a, b = root(a), root(b)
        if a < b:
            parent[b] = a
        elif b < a:
            parent[a] = b
    top = np.fromiter((root(x) for x in range(len(nodes))), np.int64, len(nodes))
    return nodes, nodes[top]


def _contract(batches):
    """The edges of one partition as stars around the smallest node of each component."""
    parts = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches]
    if not parts:
        return
    node, top = union_find(np.concatenate([p[0] for p in parts]).astype(np.int64), np.concatenate([p[1] for p in parts]).astype(np.int64))
    far = node != top
    yield pa.RecordBatch.from_arrays([pa.array(node[far], pa.int64()), pa.array(top[far], pa.int64())], ["src", "dst"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
    return both.where("dst > src").join(low, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src <> dst").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where("src <> dst")
    low = down.groupBy("src").agg(F.min("dst").alias("m"))
    moved = down.join(low, "src").where("dst <> m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return moved.unionByName(low.select("src", F.col("m").alias("dst"))).distinct()


def connected_components(edges: DataFrame, per_task: int = EDGES_PER_TASK) -> DataFrame:
    """node, component of every node of ``edges`` (bigint columns src, dst); a component is named by its smallest node.

    Each partition first shrinks its edges to a forest by union-find. Where several partitions are needed, alternating
    large-star and small-star rounds join the forests until nothing changes; every round is written to the shared
    folder. Null ends are no edges; a loop makes its node a component; repeated edges count once.
    """
    both = write_shared(edges.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL"), "edges")
    parts = -(-both.count() // per_task) or 1
    stars = write_shared(both.repartition(parts).mapInArrow(_contract, "src bigint, dst bigint"), "stars")
    if parts > 1:
        mark = None
        while True:
            stars = write_shared(_small_star(_large_star(stars)), "stars")
            now = stars.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
            if now == mark:
                break
            mark = now
    loops = both.where("src = dst").select("src", "dst").distinct()
    tops = stars.select(F.col("dst").alias("src"), "dst").distinct()
    alone = loops.join(stars, "src", "left_anti")
    return stars.unionByName(tops).unionByName(alone).distinct().select(F.col("src").alias("node"), F.col("dst").alias("component"))
