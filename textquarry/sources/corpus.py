"""Reading and writing corpora: crawl records, listings, and the tables that the pipeline leaves behind."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.functions.text import snapshot_of, uri_id_of

RECORD = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("raw_content", "url", "source_domain", "language", "bucket", "digest", "cc_segment", "date_download")]
    + [T.StructField(n, T.LongType()) for n in ("nlines", "original_nlines", "length", "original_length")]
    + [T.StructField(n, T.DoubleType()) for n in ("language_score", "perplexity")]
)
HEAD_MIDDLE = r".*/[a-z]{2}_(middle|head)\.json\.gz"


def _numbered(lines: DataFrame) -> DataFrame:
    """value, _path, idx: lines with their number in the file, for files that are never split, such as gzipped ones."""

    def run(batches):
        path, at = None, 0
        for batch in batches:
            paths = batch.column(1).dictionary_encode()
            codes = paths.indices.to_numpy()
            head = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
            idx = np.arange(len(codes), dtype=np.int64)
            for a, b in zip(head.tolist(), [*head[1:].tolist(), len(codes)]):
                name = paths.dictionary[int(codes[a])].as_py()
                at = at if name == path else 0
                idx[a:b] += at - a
                path, at = name, at + b - a
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(idx)], ["value", "_path", "idx"])

    return lines.mapInArrow(run, "value string, _path string, idx bigint")


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: T.StructType = RECORD, max_samples: int = -1) -> DataFrame:
    """Records of JSON lines (.jsonl or .gz, local, s3a or any Hadoop file system) with uri_id and idx, the line's number.

    Lines that are no JSON object are skipped but keep their number. ``max_samples`` > 0 keeps the first good rows of
    each file. A gzipped file is read by one task and its lines are numbered there, without a shuffle; other files may
    be split, and their lines are sorted by file to be numbered.
    """
    scan = spark.read.text(paths, wholetext=False)
    order = Window.partitionBy("_path").orderBy("_at")
    if all(name.endswith(".gz") for name in scan.inputFiles()):
        numbered = _numbered(scan.select("value", F.input_file_name().alias("_path")))
    else:
        lines = scan.select("value", F.input_file_name().alias("_path"), F.monotonically_increasing_id().alias("_at"))
        numbered = lines.withColumn("idx", F.row_number().over(order) - 1).drop("_at")
    parsed = numbered.withColumn("_r", F.from_json("value", T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}))
    good = parsed.where("_r IS NOT NULL AND _r._bad IS NULL AND ltrim(value) LIKE '{%'")
    if max_samples > 0:  # the bound lets Spark drop further rows before the shuffle
        good = good.withColumn("_k", F.row_number().over(Window.partitionBy("_path").orderBy("idx"))).where(F.col("_k") <= max_samples)
    uri = F.when(uri_id_of(F.col("_path")) != "", uri_id_of(F.col("_path"))).otherwise(F.col("_path"))
    return good.select("_r.*", "idx", uri.alias("uri_id"), snapshot_of(F.col("_path")).alias("snapshot_id")).drop("_bad")


def read_parquet(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Listed Parquet files under a fixed schema."""
    return spark.read.schema(schema).parquet(*paths)


def pruned(listing: DataFrame, languages: list[str], patterns: list[str] | None = None, path: str = "path") -> DataFrame:
    """Listed shards in one of the languages whose file name matches any of the patterns, with the language."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    lang = F.regexp_extract(name, r"^([a-z]{2})_", 1)
    out = listing.withColumn("language", lang).where(F.col("language").isin(languages))
    keep = F.lit(not patterns)
    for p in patterns or []:
        keep = keep | F.col(path).rlike(f"^(?:{p})")
    return out.where(keep)


def parsed_listing(listing: DataFrame, snapshot: str | None = None, path: str = "path") -> DataFrame:
    """snapshot_id, shard_id, lang_bucket of listed shards, of one snapshot if given."""
    pattern = r"^(\d{4}-\d{2})/([^/]+)/([a-z]{2}_[a-z]+)\.json\.gz$"
    cols = [F.regexp_extract(path, pattern, k).alias(n) for k, n in ((1, "snapshot_id"), (2, "shard_id"), (3, "lang_bucket"))]
    out = listing.select(path, *cols).where("snapshot_id <> ''")
    return out.where(F.col("snapshot_id") == snapshot) if snapshot else out


def head_middle(listing: DataFrame, path: str = "path") -> DataFrame:
    return listing.where(F.col(path).rlike(HEAD_MIDDLE))


def read_lists(spark: SparkSession, path: str) -> DataFrame:
    """category, domain of a block list kept as one ``domains`` file in a folder for each category."""
    rows = spark.read.text(path, recursiveFileLookup=True).withColumn("category", F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1))
    return rows.select("category", F.trim("value").alias("domain")).where("domain <> ''")


def read_phrases(spark: SparkSession, path: str) -> list[str]:
    """A phrase list, one phrase a line."""
    return [r["value"].strip() for r in spark.read.text(path).collect() if r["value"].strip()]


def read_phrase_lists(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Phrase lists by language, kept as one file for each, named by the language with or without an ending."""
    rows = spark.read.text(folder).select(F.regexp_extract(F.input_file_name(), r"([^/.]+)(\.[^/]*)?$", 1).alias("lang"), F.trim("value").alias("phrase"))
    out: dict[str, list[str]] = {}
    for r in rows.where("phrase <> ''").collect():  # word lists, some thousands of short lines
        out.setdefault(r["lang"], []).append(r["phrase"])
    return out


def listed_paths(spark: SparkSession, listing: str, base: str, languages: list[str] | None = None, patterns: list[str] | None = None) -> list[str]:
    """Full paths of the shards that a listing file names, of some languages and file patterns."""
    rows = spark.read.text(listing).select(F.trim("value").alias("path")).where("path <> ''")
    rows = pruned(rows, languages, patterns) if languages else rows
    return [f"{base.rstrip('/')}/{r['path']}" for r in rows.select("path").distinct().orderBy("path").collect()]  # the job's input paths


def write_jsonl(df: DataFrame, path: str, partition: str | None = None, mode: str = "errorifexists") -> None:
    """JSON lines, gzipped; one folder for each value of ``partition``."""
    writer = df.write.mode(mode).option("compression", "gzip")
    (writer.partitionBy(partition) if partition else writer).json(path)


def write_parquet(df: DataFrame, path: str, partition: str | None = None, mode: str = "errorifexists") -> None:
    """Parquet, one folder for each value of ``partition`` (shard, snapshot)."""
    writer = df.write.mode(mode)
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def file_pattern(languages: list[str], buckets: list[str]) -> str:
    """Path pattern of the crawl shards of some languages and buckets."""
    return rf"\d{{4}}-\d{{2}}/\d+/({'|'.join(map(re.escape, languages))})_({'|'.join(map(re.escape, buckets))})\.json\.gz"
