"""Exact duplicates in a stream of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def first_seen(stream: DataFrame, digest: Column, event_time: str, late: str) -> DataFrame:
    """The first row of each digest; state is dropped when the watermark has passed."""
    return stream.withColumn("_digest", digest).withWatermark(event_time, late).dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")
