"""Run-time helpers shared by every operator: shared storage, row locators and checked broadcasts."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its measured rows times its estimated row width stay below this; the session's setting
#: ``textquarry.broadcast.bytes`` goes before it.
BROADCAST_BYTES = 64 << 20
#: What a row of a broadcast hash table takes beside its values.
ROW_OVERHEAD = 64
#: Rows of one file are told apart by the lower bits of a locator, files by those above.
ROW_BITS = 40

_ARROW_BYTES, _ARROW_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

#: Plan nodes that keep both the rows and their order of a file scan; anything else may reorder rows on a retry.
_STABLE_NODES = {"Project", "Filter", "LogicalRelation", "Relation", "SubqueryAlias", "View"}


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors can reach, from ``spark.checkpoint.dir``.

    Where a local session names none (tests, a laptop), a private folder is made and removed at exit. On a cluster a
    folder of one machine would be lost on the others, so that a missing setting is an error there.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors can reach")
    made = tempfile.mkdtemp(prefix="textquarry-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    sc.setCheckpointDir("file://" + made)
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def session_dir(spark: SparkSession) -> str:
    """This session's folder inside the shared one; it goes when the driver's JVM ends."""
    sc = spark.sparkContext
    path = f"{shared_dir(spark)}/textquarry-{sc.applicationId}"
    if getattr(sc, "_textquarry_dir", None) != path:
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        sc._textquarry_dir = path
    return path


def put_shared(spark: SparkSession, name: str, content: bytes) -> str:
    """Write a small file into the session's shared folder; its path."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(f"{session_dir(spark)}/{name}")
    out = at.getFileSystem(sc._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(content)
    finally:
        out.close()
    return at.toString()


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends at durable files."""
    spark = df.sparkSession
    path = f"{session_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    shared_tables(spark).append(path)
    return spark.read.schema(df.schema).parquet(path).select(*[quoted(c) for c in df.columns])


def shared_tables(spark: SparkSession) -> list[str]:
    """Paths of the tables that this session has written so far and not dropped."""
    sc = spark.sparkContext
    if not hasattr(sc, "_textquarry_tables"):
        sc._textquarry_tables = []
    return sc._textquarry_tables


def drop_shared(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables of ``shared_tables``; results that still read one can't be used any more."""
    sc, held = spark.sparkContext, shared_tables(spark)
    for path in paths:
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
    held[:] = [p for p in held if p not in set(paths)]


def quoted(name: str) -> str:
    """A column's name as an expression, whatever signs it has."""
    return "`" + name.replace("`", "``") + "`"


def _plan_nodes(node) -> list[str]:
    names, todo = [], [node]
    while todo:
        x = todo.pop()
        names.append(x.nodeName().split(" ")[0])
        kids = x.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return names


def is_file_scan(df: DataFrame) -> bool:
    """Whether ``df`` is a file scan under projections and filters only."""
    names = _plan_nodes(df._jdf.queryExecution().optimizedPlan())
    return bool({"LogicalRelation", "Relation"} & set(names)) and set(names) <= _STABLE_NODES


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where a scan would keep most of them idle, such as a file of one row group; unchanged otherwise.

    Only for work that costs more than moving the rows. The filled splits are counted from the files' footers.
    """
    if not is_file_scan(df):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= 4 * cores:
        return df
    filled = df.select(F.spark_partition_id().alias("p")).distinct().count()
    return df if 2 * filled >= cores else df.repartition(cores)


def broadcast_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get("textquarry.broadcast.bytes", None) or BROADCAST_BYTES)


def _file_locator(df: DataFrame, column: str) -> DataFrame | None:
    """Locators from the file's place in the sorted list of paths and the row's place in its file; None if there are none.

    Both are properties of the files themselves: no matter how a scan is split, a row's locator stays.
    """
    meta = df.metadataColumn("_metadata")
    try:
        placed = df.withColumn(column, meta["row_index"])
        placed.schema  # noqa: B018
    except AnalysisException:  # only Parquet rows know their place
        return None
    files = len(df.inputFiles())
    if files <= 1:
        return placed
    if files * (256 + ROW_OVERHEAD) > broadcast_bytes(df.sparkSession):
        return None
    paths = sorted(r[0] for r in df.select(meta["file_path"]).distinct().collect())
    name, base = unused_name(df, "_file"), unused_name(df, "_base")
    listed = df.sparkSession.createDataFrame([(p, k << ROW_BITS) for k, p in enumerate(paths)], f"{name} string, {base} bigint")
    placed = placed.withColumn(name, meta["file_path"]).join(F.broadcast(listed), name)
    return placed.withColumn(column, F.col(base) + F.col(column)).select(*[quoted(c) for c in df.columns], column)


def with_row_id(df: DataFrame, column: str = "_rid") -> DataFrame:
    """Add a 64-bit locator that is the same in every scan of ``df``, after a lost executor and under any split.

    Rows of Parquet files have the place of their file and their place in it. Any other plan, and a list of files too
    long to be broadcast, is first written to the shared folder together with its locators.
    """
    located = _file_locator(df, column) if is_file_scan(df) else None
    return write_shared(df.withColumn(column, F.monotonically_increasing_id()), "rows") if located is None else located


def join_checked(left: DataFrame, right: DataFrame, on, how: str, row_bytes: int, rows: int | None = None) -> DataFrame:
    """Join with ``right`` broadcast if ``rows`` (counted when not given) stay small, by a shuffle otherwise.

    ``row_bytes`` is the width of the values; what a hash table takes beside them is added.
    """
    n = right.count() if rows is None else rows
    small = n * (row_bytes + ROW_OVERHEAD) <= broadcast_bytes(left.sparkSession)
    return left.join(F.broadcast(right) if small else right, on, how)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of text UDFs to a few MB, unless the session names a bound of its own.

    Spark's default of 64 MB is held several times over by every task, in the JVM and in its Python worker.
    """
    if spark.conf.get(_ARROW_BYTES, _ARROW_DEFAULT) == _ARROW_DEFAULT:
        spark.conf.set(_ARROW_BYTES, "4m")


def unused_name(df: DataFrame, name: str) -> str:
    """``name`` with as many trailing underscores as it takes to clash with no column, letter case apart."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
