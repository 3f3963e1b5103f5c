from __future__ import annotations

import ast
import gzip
import json
import os
import random

import pytest

from conftest import ROOT
from textquarry.__main__ import main
from textquarry.plans import jobs
from textquarry.sources import corpus


@pytest.fixture(scope="module")
def crawl(tmp_path_factory):
    root = tmp_path_factory.mktemp("crawl")
    draw = random.Random(8)
    texts = [" ".join(f"w{draw.randint(0, 10**6)}" for _ in range(80)) for _ in range(6)]
    shards = {"2023-06/0001/en_head.json.gz": [texts[0], texts[1], texts[2]], "2022-05/0002/en_middle.json.gz": [texts[0], texts[3], texts[1] + " more words", ""]}
    for path, own in shards.items():
        (root / path).parent.mkdir(parents=True)
        with gzip.open(root / path, "wt") as f:
            for k, t in enumerate(own):
                f.write(json.dumps({"raw_content": t, "language": "en", "bucket": "head", "length": len(t), "digest": f"sha1:{hash(t)}", "source_domain": "bad.com" if k else "good.com"}) + "\n")
    (root / "lists" / "adult").mkdir(parents=True)
    (root / "lists" / "adult" / "domains").write_text("bad.com\n")
    for name, some in (("wikipedia", texts[:3]), ("source", texts)):
        (root / f"{name}.jsonl").write_text("\n".join(json.dumps({"text": t}) for t in some))
    return root, [str(root / p) for p in shards]


def test_command_line(spark, crawl, tmp_path):
    root, paths = crawl
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    main(["--ledger", ledger, "models", "--corpus", f"wikipedia={root}/wikipedia.jsonl", "--corpus", f"source={root}/source.jsonl", "--output", f"{out}/m"])
    main(["--ledger", ledger, "signals", "--input", *paths, "--output", out, "--domains", f"{root}/lists", "--models", f"{out}/m"])
    rows = spark.read.json(f"{out}/signals").collect()
    assert len(rows) == 7
    by = {r["id"]: r["quality_signals"] for r in rows}
    one = by["2023-06/0001/en_head.json.gz/1"]
    assert one["rps_doc_word_count"][0]["score"] == 80 and one["ccnet_bucket"][0]["score"] == 0 and one["rps_doc_ut1_blacklist"][0]["score"] == 0
    assert one["rps_doc_wikipedia_importance"][0]["score"] > 0 > by["2022-05/0002/en_middle.json.gz/1"]["rps_doc_wikipedia_importance"][0]["score"]
    main(["--ledger", ledger, "cluster", "--input", f"{out}/minhash", "--output", f"{out}/clusters", "--threshold", "0.7"])
    found = {r["id"]: r["cluster_id"] for r in spark.read.parquet(f"{out}/clusters").collect()}
    a, b = "2023-06/0001/en_head.json.gz", "2022-05/0002/en_middle.json.gz"
    assert found[f"{a}/0"] == found[f"{b}/0"] and set(found) <= {f"{a}/0", f"{b}/0", f"{a}/1", f"{b}/2"}
    main(["--ledger", ledger, "exact", "--input", *paths, "--output", f"{out}/exact"])
    assert [r["doc_id"] for r in spark.read.parquet(f"{out}/exact").collect()] == [f"{b}/0"]
    main(["--ledger", ledger, "tokens", "--input", *paths, "--output", f"{out}/tokens"])
    assert sum(r["num_tokens"] for r in spark.read.parquet(f"{out}/tokens").collect()) == 80 * 5 + 82
    assert spark.read.parquet(ledger).where("status = 'SUCCESS'").count() == 5
    with pytest.raises(Exception):
        main(["--ledger", ledger, "tokens", "--input", str(tmp_path / "none"), "--output", f"{out}/t2"])
    assert spark.read.parquet(ledger).where("status = 'FAIL'").count() == 1


def test_options_of_the_signals_job(spark, crawl, tmp_path):
    root, paths = crawl
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    (root / "listing.txt").write_text("2023-06/0001/en_head.json.gz\n2022-05/0002/en_middle.json.gz\n2022-05/0003/de_head.json.gz\n")
    for kind, text in (("stop", "more\n"), ("bad", "more words\nwords\n")):
        (root / kind).mkdir(exist_ok=True)
        (root / kind / "en.txt").write_text(text)
    for name in ("source", "wikipedia"):
        rows = [json.loads(x) | {"lang": "en"} for x in (root / f"{name}.jsonl").read_text().split("\n")]
        (root / f"{name}.lang.jsonl").write_text("\n".join(json.dumps(r) for r in rows))
    for name, text in (("malware", "bad.com\n"), ("spam", "bad.com\n")):
        (root / "more" / name).mkdir(parents=True, exist_ok=True)
        (root / "more" / name / "domains").write_text(text)
    main(["models", "--by-language", "--corpus", f"wikipedia={root}/wikipedia.lang.jsonl", "--corpus", f"source={root}/source.lang.jsonl", "--output", f"{out}/m"])
    main(["classifier", "--target", f"{root}/wikipedia.lang.jsonl", "--source", f"{root}/source.lang.jsonl", "--language", "en", "--output", f"{out}/c"])
    broken = str(tmp_path / "2023-06" / "broken.json.gz")
    os.makedirs(os.path.dirname(broken))
    with open(broken, "wb") as f:
        f.write(b"no gzip at all")
    with pytest.raises(SystemExit, match="broken"):
        main(["--ledger", ledger, "signals", "--input", broken, "--listing", f"{root}/listing.txt", "--base", str(root), "--languages", "en", "--max-docs", "3", "--files-per-job", "1", "--output", out, "--domains", f"{root}/more", "--categories", "malware", "--stop-words", f"{root}/stop", "--bad-words", f"{root}/bad", "--models", f"{out}/m", "--classifier", f"quality@en={out}/c"])
    by = {r["id"]: r["quality_signals"] for r in spark.read.json(f"{out}/signals").collect()}
    assert len(by) == 6 and spark.read.parquet(f"{out}/minhash").count() == 6
    one = by["2022-05/0002/en_middle.json.gz/2"]
    assert one["rps_doc_ldnoobw_words"][0]["score"] == 2 and one["rps_doc_stop_word_fraction"][0]["score"] == round(1 / 82, 8) and one["rps_doc_ut1_blacklist"][0]["score"] == 0
    assert 0 < one["quality"][0]["score"] < 1 and one["rps_doc_wikipedia_importance"][0]["score"] is not None
    rows = spark.read.parquet(ledger).collect()
    assert sorted((r["status"], r["n_records"]) for r in rows if r["status"] == "SUCCESS") == [("SUCCESS", 3), ("SUCCESS", 3)] and sum(r["status"] == "FAIL" for r in rows) == 1


def test_scores_take_no_shuffle_of_texts(spark, crawl):
    records = corpus.read_jsonl(spark, crawl[1])
    models, rates = jobs.prepare_models({"wikipedia": spark.read.json(f"{crawl[0]}/wikipedia.jsonl"), "source": spark.read.json(f"{crawl[0]}/source.jsonl")})
    plan = jobs.annotate_records(records, models=models, rates=rates, keep_bands=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan
    assert plan.count("ArrowEvalPython") <= 3


def test_minhash_schema(spark, crawl):
    rows = jobs.minhash_records(corpus.read_jsonl(spark, crawl[1]))
    assert rows.columns == ["shard_id", "id", "id_int", "signature_sim0.7", "signature_sim0.8", "signature_sim0.9", "signature_sim1.0"]


def test_core_imports_nothing_of_the_training_operators():
    for folder, _, files in os.walk(os.path.join(ROOT, "textquarry")):
        if os.sep + "llm" in folder:
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    tree = ast.parse(f.read())
                for node in ast.walk(tree):
                    names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                    assert not any("llm" in n.split(".") or n == "corpus_pipeline" for n in names), name
