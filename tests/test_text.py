from __future__ import annotations

import math
import random
import re
import string
import unicodedata
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textquarry.functions import text as X
from textquarry.operators import signals
from textquarry.operators.repetition import FIELDS, measure_batch

SPECIAL = ["", "   \n", "a a a a", "a bb a bb cc d cc d", "x\n\ny", "foo-bar", "{ lorem ipsum }", "Wait... what…", "• item\n– item", "é", "é", "JavaScript, javascript!", "A B　c", "漢字 かな 123", "NO caps HERE Ⅷ", "end”  \nnext?", "one\r\ntwo\vthree\x85", "don't stop. Now! ok"]


def model_norm(t: str) -> str:
    t = t.translate(str.maketrans("", "", string.punctuation)).lower()
    return unicodedata.normalize("NFD", " ".join(t.split()))


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(1)
    words = ["a", "bb", "the", "of", "Über", "çà", "#", "...", "x1", "END", ".", "\n", "hell"]
    texts = SPECIAL + [" ".join(draw.choice(words) for _ in range(draw.randint(1, 60))) for _ in range(40)]
    data = [(k, t, "en") for k, t in enumerate(texts)] + [(1000, None, None), (1001, "the of", "xx")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
    picked = signals.all_line_scores(signals.prepared(docs))
    picked = picked.select("doc_id", "text", "_norm", "_words", "_raw", "_lines", *[b().alias(n) for n, b in signals.DOC_SIGNALS.items()], *signals.line_names())
    return {r["doc_id"]: r for r in picked.collect()}


def test_normal_words_and_lines(rows):
    for r in rows.values():
        t = r["text"] or ""
        assert r["_norm"] == model_norm(t)
        assert r["_words"] == model_norm(t).split()
        assert r["_raw"] == re.findall(r"\w+|[^\w\s]+", t)
        spans = [(x["text"], x["start"], x["end"]) for x in r["_lines"]]
        assert "".join(s for s, _, _ in spans) == t
        assert [(a, b) for _, a, b in spans] == [m.span() for m in re.finditer(r"[^\n]+\n?|\n", t)]


def test_document_signals(rows):
    for r in rows.values():
        t = r["text"] or ""
        w, raw = model_norm(t).split(), re.findall(r"\w+|[^\w\s]+", t)
        assert r["rps_doc_word_count"] == len(w)
        assert r["rps_doc_num_sentences"] == len(re.findall(r"\b[^.!?]+[.!?]*", t))
        assert r["rps_doc_mean_word_length"] == (pytest.approx(sum(map(len, w)) / len(w), abs=1e-8) if w else None)
        symbols = t.count("#") + t.count("...") + t.count("…")
        assert r["rps_doc_symbol_to_word_ratio"] == (pytest.approx(symbols / len(raw), abs=1e-8) if raw else None)
        alpha = sum(1 for x in raw if re.search("[a-zA-Z]", x))
        assert r["rps_doc_frac_no_alph_words"] == (pytest.approx(1 - alpha / len(raw), abs=1e-8) if raw else None)
        assert r["rps_doc_frac_unique_words"] == (pytest.approx(len(set(w)) / len(w), abs=1e-8) if w else None)
        entropy = -sum(n / len(w) * math.log(n / len(w)) for n in Counter(w).values())
        assert r["rps_doc_unigram_entropy"] == (pytest.approx(entropy, abs=1e-7) if w else None)
        lines = t.splitlines() if not re.search("[\v\x85\r]", t) else None
        if lines:
            share = sum(x.rstrip().endswith(("...", "…")) for x in lines) / len(lines)
            assert r["rps_doc_frac_lines_end_with_ellipsis"] == pytest.approx(share, abs=1e-8)


def model_top(w: list[str], n: int) -> float:
    grams = [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]
    if not grams:
        return 0.0
    gram, count = Counter(grams).most_common(1)[0]
    return sum(map(len, gram)) * count / sum(map(len, w)) if count > 1 else 0.0


def model_dupe(w: list[str], n: int) -> float:
    times = Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    marked = {k + j for k in range(len(w) - n + 1) if times[tuple(w[k : k + n])] > 1 for j in range(n)}
    return sum(len(w[k]) for k in marked) / sum(map(len, w)) if w else 0.0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "bb", "é", "dd"]), max_size=40), max_size=5))
def test_repetitions(texts):
    import pyarrow as pa

    got = measure_batch(pa.array([" ".join(w) for w in texts], pa.string())).to_pylist()
    for w, row in zip(texts, got):
        for n in (2, 3, 4):
            assert row[f"top_{n}gram"] == pytest.approx(model_top(w, n))
        for n in range(5, 11):
            assert row[f"dupe_{n}grams"] == pytest.approx(model_dupe(w, n))
        assert (row["entropy"] is None) == (not w)


def test_repetitions_of_nulls():
    import pyarrow as pa

    got = measure_batch(pa.array([None, "", "a a"], pa.string())).to_pylist()
    assert got[0] == dict.fromkeys(FIELDS) and got[1]["entropy"] is None and got[2]["entropy"] == 0.0


def test_golden(rows):
    by = {r["text"]: r for r in rows.values()}
    assert by["a a a a"]["rps_doc_frac_chars_top_2gram"] == 1.5
    assert by["{ lorem ipsum }"]["rps_doc_curly_bracket"] == round(2 / 15, 8)
    assert by["{ lorem ipsum }"]["rps_doc_lorem_ipsum"] == round(1 / 11, 8)
    assert [x["score"] for x in by["• item\n– item"]["rps_lines_start_with_bulletpoint"]] == [1.0, 1.0]
    assert by["é"]["_norm"] == by["é"]["_norm"]
    assert [x["score"] for x in by["JavaScript, javascript!"]["rps_lines_javascript_counts"]] == [2.0]
    assert [tuple(x) for x in by[""]["rps_lines_start_with_bulletpoint"]] == [(0, 0, None)]
    assert by[""]["rps_lines_num_words"] == []
    assert by["end”  \nnext?"]["rps_lines_ending_with_terminal_punctution_mark"][0]["score"] == 1.0
    assert by["NO caps HERE Ⅷ"]["rps_doc_frac_all_caps_words"] == 0.5
    assert rows[1001]["rps_doc_stop_word_fraction"] is None and rows[1000]["rps_doc_word_count"] == 0.0
    assert by["漢字 かな 123"]["rps_lines_numerical_chars_fraction"][0]["score"] == round(3 / 9, 8)


def test_small_helpers(spark):
    r = spark.range(1).select(
        X.snapshot_of(F.lit("s3://b/2023-06/0001/en_head.json.gz")).alias("s"),
        X.uri_id_of(F.lit("s3://b/2023-06/0001/en_head.json.gz")).alias("u"),
        X.bucket_code(F.lit("tail")).alias("b"),
        X.sha1_hash32(F.lit("abc")).alias("h"),
        X.text_span(F.lit("One, two!\nThree four"), 1, 2).alias("t"),
        X.classifier_text(F.lit(" a\r\nb\x85c\n")).alias("c"),
    ).first()
    assert (r["s"], r["u"], r["b"], r["t"], r["c"]) == ("2023-06", "2023-06/0001/en_head.json.gz", 2.0, "two three", "a b c")
    import hashlib

    assert r["h"] == int.from_bytes(hashlib.sha1(b"abc").digest()[:4], "little")


def test_record(spark):
    docs = spark.createDataFrame([("1", "Hello world.\nBye", "en", "s"), ("2", None, None, "s")], "doc_id string, text string, lang string, source string")
    rows = signals.annotate(docs, "doc_id", "source").orderBy("id").collect()
    assert [r["id"] for r in rows] == ["s/1", "s/2"]
    assert [tuple(x) for x in rows[0]["quality_signals"]["rps_doc_word_count"]] == [(0, 16, 3.0)]
    assert rows[1]["quality_signals"]["rps_lines_num_words"] == []
