"""Two-pass external shuffle of a table into shards of random order.

The first pass scatters every record to a bucket by a seeded hash of its place in the table, uniformly whatever the
records hold and sized to fit one task's memory; the second shuffles each bucket by Fisher-Yates with a generator
seeded by the bucket and writes it. Shards read one after another are a uniform permutation of the table, and the same
seed gives the same one, however a scan is split.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.plans.runtime import quoted, session_dir, unused_name, with_row_id

SEED = 20240229
BUCKET_BYTES = 16 << 20


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A permutation of 0..n-1: from the end, each place swaps with a random one at or before it."""
    order = np.arange(n)
    if n < 2:
        return order
    draws = np.random.Generator(np.random.PCG64(seed)).integers(0, np.arange(n, 1, -1)).tolist()
    held = order.tolist()
    for k, j in zip(range(n - 1, 0, -1), draws):
        held[k], held[j] = held[j], held[k]
    return np.array(held)


def _width(c: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
        return F.greatest(F.size(c), F.lit(0)) * 8
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
    return F.lit(0)


def bucket_count(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets so that each holds about ``bucket_bytes``; every column counts 16 bytes beside its texts, lists and records."""
    width = sum((_width(F.col(quoted(f.name)), f.dataType) for f in docs.schema.fields), F.lit(16 * len(docs.columns)))
    total = docs.agg(F.sum(width.cast("bigint")).alias("b")).first()["b"] or 0
    return max(1, -(-int(total) // bucket_bytes))


def shuffled(docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, shard: str = "shard", place: str = "place") -> DataFrame:
    """All rows and columns, and two more: the shard and the place in its random order, both from 0.

    The order depends on the seed, the number of buckets and the rows' places in the table's files (a table that is no
    Parquet files is written first), not on what they hold: a third of all rows may be equal, null or of one source and
    still go to all buckets alike. Where the table has a column ``shard`` or ``place``, the new one gets a trailing
    underscore; names with any signs will do. An empty table gives no rows. A text larger than a bucket makes its bucket
    larger; it is never cut.
    """
    shard, place = unused_name(docs, shard), unused_name(docs, place)
    n = bucket_count(docs, bucket_bytes)
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = with_row_id(docs, unused_name(docs, "_rid")).toDF(*names, "rid")
    scattered = plain.withColumn("key", F.xxhash64(F.lit(seed), "rid")).withColumn("shard", F.pmod("key", F.lit(n)))

    def shuffle(table: pa.Table) -> pa.Table:
        at = table.column("shard")[0].as_py()
        table = table.take(pa.compute.sort_indices(table.select(["key", "rid"]), [("key", "ascending"), ("rid", "ascending")]))
        order = fisher_yates(table.num_rows, [seed, at])
        table = table.take(pa.array(order)).drop_columns(["key", "rid"])
        return table.append_column("place", pa.array(np.arange(table.num_rows), pa.int64()))

    kept = [T.StructField(name, f.dataType) for name, f in zip(names, docs.schema.fields)]
    schema = T.StructType([*kept, T.StructField("shard", T.LongType()), T.StructField("place", T.LongType())])
    return scattered.groupBy("shard").applyInArrow(shuffle, schema).toDF(*docs.columns, shard, place)


def write_shards(docs: DataFrame, path: str, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write the shuffled table as Parquet, one folder a shard, rows in the order of their places, and read it back."""
    rows = shuffled(docs, seed, bucket_bytes)
    shard, place = rows.columns[-2:]
    rows.sortWithinPartitions(quoted(shard), quoted(place)).write.partitionBy(shard).parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path).select(*[quoted(c) for c in rows.columns])


def sharded(docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The table as ``write_shards`` leaves it in the shared folder; see ``shuffled`` for its rows and columns."""
    return write_shards(docs, f"{session_dir(docs.sparkSession)}/shards-{uuid.uuid4().hex}", seed, bucket_bytes)
