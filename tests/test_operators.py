from __future__ import annotations

import gzip
import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textquarry.functions.lexicons import CATEGORIES
from textquarry.operators import dedup, importance, sampling
from textquarry.operators.components import connected_components
from textquarry.sources import corpus


def model_components(edges):
    top = {}

    def root(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
    return {x: root(x) for x in top}


@pytest.mark.parametrize("per_task", [2_000_000, 40])
def test_components(spark, per_task):
    draw = random.Random(7)
    edges = [(draw.randint(-50, 150), draw.randint(-50, 150)) for _ in range(120)] + [(k, k + 1) for k in range(500, 560)] + [(9, 9), (900, 900)]
    df = spark.createDataFrame(edges + [(None, 1)], "src bigint, dst bigint")
    got = {r["node"]: r["component"] for r in connected_components(df, per_task).collect()}
    assert got == model_components(edges)


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).collect() == []


def test_bands_and_permutations():
    assert [dedup.optimal_bands(t) for t in (0.7, 0.8, 0.9, 1.0)] == [(14, 9), (9, 13), (5, 25), (1, 128)]
    assert dedup.permutation_checksum().startswith("6a5665743fa18846")
    a, b = dedup.permutations()
    assert (int(a[0]), int(b[0])) == (2297359619001564596, 1396682528897996046)


def test_signature(spark):
    words = [f"w{k % 11}" for k in range(30)]
    grams = {" ".join(words[k : k + 13]) for k in range(18)}
    a, b = dedup.permutations()
    want = [min((((int.from_bytes(hashlib.sha1(g.encode()).digest()[:4], "little") * int(x) + int(y)) % (1 << 64)) % dedup.PRIME) & dedup.MASK for g in grams) for x, y in zip(a, b)]
    df = spark.createDataFrame([(" ".join(words),), (" ".join(words[:12]),), ("",)], "norm string").select(dedup.signatures(F.col("norm")).alias("s"))
    assert [r["s"] for r in df.collect()] == [want, None, None]
    rows = dedup.minhash_rows(spark.createDataFrame([(" ".join(words),)], "norm string"), F.col("norm")).first()
    assert rows["signature_sim0.7"][0] == np.array(want[:9], ">u4").tobytes() and len(rows["signature_sim1.0"]) == 1


def test_clusters_of_near_copies(spark):
    draw = random.Random(3)
    base = [f"w{draw.randint(0, 10**6)}" for _ in range(300)]
    near = base[:150] + ["x"] + base[151:]
    far = [f"v{draw.randint(0, 10**6)}" for _ in range(300)]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(base))]
    docs = spark.createDataFrame(rows, "doc_id bigint, norm string")
    keys = docs.select("doc_id", dedup.signatures(F.col("norm")).alias("s")).select("doc_id", dedup.bands(F.col("s"), 0.7).alias("keys"))
    found = dedup.attach_clusters(docs, dedup.clusters(dedup.lsh_edges(keys, "doc_id", "keys")), "doc_id")
    assert {r["doc_id"]: r["cluster_id"] for r in found.collect()} == {1: 1, 2: 1, 4: 1}


def test_unsigned_ids(spark):
    df = spark.createDataFrame([("0",), ("18446744073709551615",), ("9223372036854775808",)], "x string")
    back = df.select("x", dedup.unsigned(dedup.signed(F.col("x"))).cast("string").alias("y")).collect()
    assert all(r["x"] == r["y"] for r in back)


def test_exact_duplicates_prefer_new_shards(spark):
    df = spark.createDataFrame([("2022-05", 1, "sha1:a"), ("2023-06", 2, "a"), ("2023-06", 3, "b"), ("2023-06", 4, None), ("2022-05", 5, None)], "s string, d int, g string")
    assert [(r["shard_id"], r["doc_id"], r["digest"]) for r in dedup.exact_duplicates(df, "s", "d", F.col("g")).collect()] == [("2022-05", 1, "a")]


def test_exact_duplicates_against_brute_force(spark):
    """A digest that a third of all rows has, equal rows, nulls; every row but the first of each digest."""
    draw = random.Random(4)
    rows = [(draw.choice(["a", "b", "c", None]), draw.randint(0, 30), "hot" if k % 3 == 0 else f"g{draw.randint(0, 40)}") for k in range(600)] + [("a", None, "hot"), ("z", 1, None)]
    df = spark.createDataFrame(rows, "s string, d int, g string").repartition(5)
    got = sorted(((r["shard_id"], r["doc_id"], r["digest"]) for r in dedup.exact_duplicates(df, "s", "d", F.col("g")).collect()), key=repr)
    want = []
    for g in {r[2] for r in rows if r[2]}:
        own = sorted((r for r in rows if r[2] == g), key=lambda r: (r[1] is None, r[1] or 0))
        own.sort(key=lambda r: r[0] or "", reverse=True)
        want += own[1:]
    assert got == sorted(want, key=repr)
    plan = dedup.exact_duplicates(df, "s", "d", F.col("g"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_count" in plan


def test_grams_against_brute_force(spark):
    """Buckets, sums and means of odd texts, and none of it shuffled."""
    texts = ["", None, "a", "a b a b", "Ünï código — x", "x " * 3000, "a b\nc"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    import re

    weights = [((b * 7919) % 2001 - 1000) / 1000.0 for b in range(importance.BUCKETS)]
    table = spark.createDataFrame([(b, w) for b, w in enumerate(weights)], "bucket int, lr double")
    counts, sums = {}, {}
    for k, t in enumerate(texts):
        w = re.findall(r"\w+|[^\w\s]+", t or "")
        for g in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]:
            b = int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % importance.BUCKETS
            counts[k, b] = counts.get((k, b), 0) + 1
            sums[k] = sums.get(k, 0.0) + weights[b]
    found = importance.hash_features(df)
    assert {(r["doc_id"], r["bucket"]): r["cnt"] for r in found.collect()} == counts
    scored = importance.importance(df, table)
    assert {r["doc_id"]: r["importance"] for r in scored.collect()} == pytest.approx(sums)
    for x in (found, scored, importance.linear_score(df, table.withColumnRenamed("lr", "weight"))):
        plan = x._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
    parts = importance.ngram_model(df.withColumn("half", F.when(F.col("doc_id") > 3, "b").otherwise("a")), by="half").groupBy("bucket").agg(F.sum("cnt").alias("n"))
    assert {r["bucket"]: r["n"] for r in parts.collect()} == {r["bucket"]: r["cnt"] for r in importance.ngram_model(df).collect()}


def test_pretrained_token_counts(spark):
    from tokenizers import Tokenizer

    from textquarry.queries import TOKENIZER

    texts = ["", None, "one two", "Ünï código " * 50, "x" * 3000]
    held = Tokenizer.from_file(TOKENIZER)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    got = {r["doc_id"]: r["n"] for r in df.select("doc_id", sampling.pretrained_token_count(F.col("text"), TOKENIZER).alias("n")).collect()}
    assert got == {k: len(held.encode(t or "").ids) for k, t in enumerate(texts)}


def test_tables_of_the_session_can_be_dropped(spark):
    from textquarry.plans import runtime

    before = len(runtime.shared_tables(spark))
    kept, gone = (runtime.write_shared(spark.range(3).withColumnRenamed("id", "a.b"), "x") for _ in range(2))
    runtime.drop_shared(spark, runtime.shared_tables(spark)[before + 1 :])
    assert kept.count() == 3 and len(runtime.shared_tables(spark)) == before + 1
    with pytest.raises(Exception):
        gone.collect()


def test_user_signals(spark):
    from textquarry.operators import signals

    @signals.doc_signal("own_length")
    def _length():
        return F.length("_text")

    @signals.line_signal("own_stars")
    def _stars(line):
        return F.regexp_count(line, F.lit(r"\*"))

    try:
        r = signals.annotate(spark.createDataFrame([(1, "a*\n**", "en", "s")], "doc_id int, text string, lang string, source string"), "doc_id", "source").first()["quality_signals"]
        assert [tuple(x) for x in r["own_length"]] == [(0, 5, 5.0)] and [tuple(x) for x in r["own_stars"]] == [(0, 3, 1.0), (3, 5, 2.0)]
    finally:
        del signals.DOC_SIGNALS["own_length"], signals.LINE_SIGNALS["own_stars"]


def test_balanced_training_rows(spark):
    rows = lambda n, base: spark.createDataFrame([(base + k, f"t{base + k}") for k in range(n)], "doc_id int, text string")
    got = importance.balanced([rows(50, 0), rows(3, 100)], rows(500, 1000), 20, F.xxhash64("doc_id")).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in got} == {1: 13, 0: 20}


def test_seeded_shuffle(spark):
    df = spark.range(500).repartition(7)
    one, two = ([r["id"] for r in sampling.shuffled(df, seed, ["id"]).collect()] for seed in (1, 2))
    assert sorted(one) == sorted(two) == list(range(500)) and one != two and one == [r["id"] for r in sampling.shuffled(spark.range(500).repartition(3), 1, ["id"]).collect()]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from textquarry.plans import runtime

    none = SimpleNamespace(getConf=lambda: SimpleNamespace(get=lambda *_: None), _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False))), master="yarn")
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        runtime.shared_dir(SimpleNamespace(sparkContext=none))


def test_core_queries_survive_a_broken_subpackage(monkeypatch):
    import sys

    import __spark_entry__ as driver

    monkeypatch.setitem(sys.modules, "textquarry.llm.queries", None)
    assert "dup_clusters" in driver.queries() and not any(n.startswith("op1") for n in driver.queries()) and "exact_dup" in driver.oracle_sql()


def test_log_gamma(spark):
    import math

    rows = spark.createDataFrame([(float(k),) for k in (1, 2, 3, 10, 150, 20000)], "x double").select("x", importance.log_gamma(F.col("x")).alias("y")).collect()
    assert all(r["y"] == pytest.approx(math.lgamma(r["x"]), abs=1e-8, rel=1e-11) for r in rows)


def test_classifier(spark):
    rows = [(k, "good fine text" if k % 2 else "bad poor words", k % 2) for k in range(40)] + [(99, "", 0), (100, None, 0)]
    df = spark.createDataFrame(rows, "doc_id int, text string, label int")
    model = importance.train_classifier(df.where("doc_id < 40"))
    got = {r["doc_id"]: r["score"] for r in importance.classifier_scores(model, df).collect()}
    assert got[1] > 0.5 > got[2] and got[99] is None and got[100] is None


def test_category_sets():
    sets = sampling.category_sets(CATEGORIES)
    assert len(sets) == 2 ** len(CATEGORIES) - 1 and sets[0] == (0, ["adult"]) and [len(c) for _, c in sets] == sorted(len(c) for _, c in sets)


def test_jsonl(spark, tmp_path):
    folder = tmp_path / "2023-06" / "0001"
    folder.mkdir(parents=True)
    lines = [json.dumps({"raw_content": "a", "length": 1, "extra": 2}), "{broken", json.dumps({"raw_content": "b", "language_score": 0.5}), "[1]", json.dumps({"raw_content": "c"})]
    with gzip.open(folder / "en_head.json.gz", "wt") as f:
        f.write("\n".join(lines))
    got = corpus.read_jsonl(spark, str(folder / "en_head.json.gz")).orderBy("idx").collect()
    assert [(r["raw_content"], r["idx"], r["uri_id"], r["snapshot_id"]) for r in got] == [(x, k, "2023-06/0001/en_head.json.gz", "2023-06") for x, k in (("a", 0), ("b", 2), ("c", 4))]
    assert corpus.read_jsonl(spark, str(folder / "en_head.json.gz"), max_samples=2).count() == 2
    for k in range(3):
        with gzip.open(folder / f"more{k}.json.gz", "wt") as f:
            f.write("\n".join(json.dumps({"raw_content": f"{k}-{n}"}) for n in range(20_000)))
    many = corpus.read_jsonl(spark, str(folder))
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert many.where("raw_content LIKE '%-%' AND concat(regexp_extract(uri_id, 'more([0-9])', 1), '-', idx) <> raw_content").count() == 0 and many.count() == 60_003
    (folder / "plain.jsonl").write_text("\n".join(lines))
    assert sorted(r["idx"] for r in corpus.read_jsonl(spark, str(folder / "plain.jsonl")).collect()) == [0, 2, 4]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, shard string")
    corpus.write_jsonl(df, str(tmp_path / "j"), "shard")
    corpus.write_parquet(df, str(tmp_path / "p"), "shard")
    assert corpus.read_parquet(spark, [str(tmp_path / "p")], df.schema).orderBy("x").collect() == df.orderBy("x").collect()
    assert spark.read.json(str(tmp_path / "j")).count() == spark.read.parquet(str(tmp_path / "p")).count() == 2


def test_listing(spark):
    df = spark.createDataFrame([("2023-06/0001/en_head.json.gz",), ("2023-06/0001/de_tail.json.gz",), ("x",)], "path string")
    assert [r["language"] for r in corpus.pruned(df, ["en", "de"], [corpus.file_pattern(["en"], ["head"])]).collect()] == ["en"]
    assert corpus.parsed_listing(df, "2023-06").count() == 2 and corpus.head_middle(df).count() == 1


def test_block_lists(spark, tmp_path):
    for name, text in (("adult", "a.com\nb.com\n"), ("malware", "a.com\n\n")):
        (tmp_path / "l" / name).mkdir(parents=True)
        (tmp_path / "l" / name / "domains").write_text(text)
    got = {(r["category"], r["domain"]) for r in corpus.read_lists(spark, str(tmp_path / "l")).collect()}
    assert got == {("adult", "a.com"), ("adult", "b.com"), ("malware", "a.com")}
    assert corpus.read_phrases(spark, str(tmp_path / "l" / "adult" / "domains")) == ["a.com", "b.com"]


def test_stream_keeps_first_of_each_digest(spark, tmp_path):
    from textquarry.streaming.dedup import first_seen

    schema = "ts timestamp, text string"
    rows = [("2024-01-01 00:00:00", "a"), ("2024-01-01 00:00:01", "b"), ("2024-01-01 00:00:02", "a")]
    spark.createDataFrame([(t, x) for t, x in rows], "t string, text string").selectExpr("timestamp(t) AS ts", "text").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = first_seen(stream, F.sha1("text"), "ts", "1 hour").writeStream.format("memory").queryName("seen").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
        assert sorted(r["text"] for r in spark.table("seen").collect()) == ["a", "b"]
    finally:
        q.stop()
