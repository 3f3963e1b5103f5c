from __future__ import annotations

import string
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textquarry.functions import batches
from textquarry.functions import text as X
from textquarry.operators import signals

ODD = ["", " ", "\u3000", "a", " a\u00a0\u2003b\t", "\u2028x\u202f-y\u205f", "don't STOP", "\u00c9\u0301 \u1680\u00e9", "\u0391\u03a3-\u0391 \u0391\u03a3", "\u0130!", "\u200bz\u2010", "\U0001d54f\x1c\x1f\x85", None]


def model(t):
    return unicodedata.normalize("NFD", " ".join(t.translate(str.maketrans("", "", string.punctuation)).lower().split()))


@pytest.mark.parametrize("run_bytes", [1, 9, 1 << 20])
def test_normalised_in_runs(spark, monkeypatch, run_bytes):
    monkeypatch.setattr(batches, "RUN_BYTES", run_bytes)
    lower = [None if t is None else t.lower() for t in ODD]
    assert batches.tidied(pa.array(lower)).to_pylist() == [None if t is None else model(t) for t in lower]
    df = spark.createDataFrame([(t,) for t in ODD], "text string")
    got = [r[0] for r in df.select(X.normalize(F.col("text"))).collect()]
    assert got == [r[0] for r in df.select(X.nfd(F.trim(F.regexp_replace(F.lower(F.translate("text", X.PUNCTUATION, "")), f"[{X.SPACE}]+", " ")))).collect()]


def test_signals_bound_their_batches(spark):
    """A worker holds a batch several times over: its bytes are bounded, however long the documents are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        signals.prepared(spark.createDataFrame([("a b", "en")], "text string, lang string"))
        assert spark.conf.get(name) == "4m"
    finally:
        spark.conf.set(name, before)
