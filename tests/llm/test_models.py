"""Language ID, byte-level BPE, pages and sharding against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import itertools
import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textquarry.llm import bpe, html, langid, sharding

EXTRA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _verdict string, shard string, place_ int, Place int"


def documents(spark, rows):
    return spark.createDataFrame([(d, t, lang, "s", None, None, None, None, None) for d, t, lang in rows], EXTRA)


# --- language ID


@pytest.fixture(scope="module")
def languages():
    draw = random.Random(1)
    parts = {"en": "th he in er an re on at nd ing".split(), "fr": "é è le que ou ai eau tre ment ch".split(), "de": "sch ü ung ein ie ch er tz ver keit".split()}
    text = lambda lang, n: " ".join("".join(draw.choices(parts[lang], k=draw.randint(2, 4))) for _ in range(n))
    return text


def test_languages_of_held_out_documents(spark, languages):
    train = [(k, languages(lang, 80), lang) for k in range(60) for lang in ("en", "fr", "de")]
    held = [(k, languages(lang, 80), lang) for k in range(40) for lang in ("en", "fr", "de")]
    model = langid.train(documents(spark, train + [(1, None, "en"), (2, "x", None)]))
    got = {(r["doc_id"], r["lang"]) for r in langid.identify(documents(spark, held), model).collect()}
    assert len(got & {(d, lang) for d, _, lang in held}) >= 0.98 * len(held)


def test_mixtures_and_odd_texts(spark, languages):
    model = langid.train(documents(spark, [(k, languages(lang, 80), lang) for k in range(60) for lang in ("en", "fr", "de")]))
    rows = [(1, languages("en", 300) + " " + languages("fr", 100), None), (2, None, "en"), (3, "", "en"), (4, "12 34 !!", "en"), (5, "qxj wvk zzp xqk jwv " * 60, "en"), (6, languages("de", 20000), "en"), (6, "th", "en")]
    got = {}
    for r in langid.identify(documents(spark, rows), model).collect():
        got.setdefault(r["doc_id"], []).append(r)
    mixed = got[1][0]
    assert mixed["langs"][:2] == ["en", "fr"] and mixed["shares"][0] == pytest.approx(0.75, abs=0.1) and not mixed["rejected"]
    assert [got[k][0]["lang"] for k in (2, 3, 4, 5)] == ["und"] * 4 and all(got[k][0]["rejected"] for k in (2, 3, 4, 5))
    assert {r["lang"] for r in got[6]} >= {"de"}
    kept = langid.keep_identified(documents(spark, rows), model)
    assert kept.columns == [c.split()[0] for c in EXTRA.split(", ")] and {r["doc_id"] for r in kept.collect()} >= {1, 6}
    assert not {r["doc_id"] for r in kept.collect()} & {2, 3, 4, 5}
    none = documents(spark, rows).limit(0)
    assert langid.identify(none).count() == 0


def test_short_texts_are_judged_like_long_ones(spark, languages):
    model = langid.train(documents(spark, [(k, languages(lang, 80), lang) for k in range(60) for lang in ("en", "fr", "de")]))
    junk = "qxj wvk zzp xqk jwv qqz"
    rows = [(n, " ".join([junk] * n), None) for n in (1, 2, 3, 4, 8)] + [(100 + n, languages("en", n), None) for n in (5, 10, 20, 40)]
    got = {r["doc_id"]: r for r in langid.identify(documents(spark, rows), model).collect()}
    assert got[1]["n_grams"] < 50 < got[4]["n_grams"] and all(got[n]["rejected"] == (n < 100) for n in got)


def test_chosen_sets_are_the_best_of_all():
    """Backward elimination against every set of components."""
    draw, same = np.random.default_rng(6), 0
    for _ in range(60):
        like = draw.dirichlet(np.full(40, 0.3), 4).T + 1e-4
        counts = draw.multinomial(draw.integers(20, 600), (p := like @ draw.dirichlet(np.full(4, 0.4))) / p.sum())
        seen = np.flatnonzero(counts)
        counts, like = counts[seen].astype(float), like[seen]
        cost = langid.PENALTY * np.log(counts.sum())
        score = lambda live: langid.em_shares(counts, like[:, live], np.ones(len(live)), 400, 1e-7)[1] - cost * len(live)
        best = max((tuple(s) for n in range(1, 5) for s in itertools.combinations(range(4), n)), key=lambda s: score(list(s)))
        same += set(langid.choose_languages(counts, like)[0].tolist()) == set(best)
    assert same >= 57


def test_em_finds_the_most_likely_shares():
    draw = np.random.default_rng(4)
    like = draw.dirichlet(np.ones(30), 3).T
    counts = draw.integers(1, 20, 30).astype(float)
    shares, fit = langid.em_shares(counts, like, np.ones(3), steps=4000, tol=1e-10)
    grid = [np.array([a, b, 1 - a - b]) for a in np.linspace(0, 1, 51) for b in np.linspace(0, 1, 51) if a + b <= 1]
    assert fit >= max(counts @ np.log(np.maximum(like @ g, 1e-300)) for g in grid) - 1e-6
    assert shares.sum() == pytest.approx(1.0)


# --- byte-level BPE


def reference_encoding():
    import tiktoken

    with open(bpe.VOCABULARY, "rb") as lines:
        import base64

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", " ", "Hello world", "don't you'll we've I'm 's  'd", "a  b   c\n\n d\t\te", "über naïve façade", "漢字かな 한국어 العربية", "🙂🙃 emoji 👩‍👩‍👧", "aaaaaaaaaaaaaaaaaaaaaaa", "\x00\x01\x7f", "x" * 5000, "'S 'T it'S", "1234567 89", "<|endoftext|>", "end \n", "'", "''s", "é'll", "　wide space ", "ﬁ ligature ½ ²"]


def test_bpe_against_a_library():
    known, vocabulary = reference_encoding(), bpe.load_vocabulary()
    flat, cuts, back = bpe.encode(pa.array(TEXTS), vocabulary)
    for k, t in enumerate(TEXTS):
        assert flat[cuts[k] : cuts[k + 1]].tolist() == known.encode_ordinary(t), repr(t)
    assert bytes(back) == "".join(TEXTS).encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'sdtlreva1é")), max_size=40), max_size=6))
def test_bpe_round_trip(texts):
    known, vocabulary = reference_encoding_cached(), bpe.load_vocabulary()
    flat, cuts, back = bpe.encode(pa.array(texts, pa.string()), vocabulary)
    assert bytes(back) == "".join(texts).encode()
    for k, t in enumerate(texts):
        assert vocabulary.decode(flat[cuts[k] : cuts[k + 1]]).tobytes() == t.encode()
        if t.isascii():  # libraries differ in the Unicode version of their classes
            assert flat[cuts[k] : cuts[k + 1]].tolist() == known.encode_ordinary(t)


_held = []


def reference_encoding_cached():
    if not _held:
        _held.append(reference_encoding())
    return _held[0]


def test_bpe_words_of_the_corpus(spark):
    draw = random.Random(7)
    texts = [" ".join(draw.choices(["alpha", "beta", "Gamma", "delta's", "42", "—"], k=30)) for _ in range(40)] + ["once only"]
    df = documents(spark, [(k, t, None) for k, t in enumerate(texts)]).repartition(3)
    vocabulary, known = spark.sparkContext.broadcast(bpe.load_vocabulary()), reference_encoding_cached()
    want = Counter(part for t in texts for part in bpe.regex.findall(bpe.PATTERN, t))
    assert {bytes(r["word"]).decode(): r["n"] for r in bpe.word_counts(df, chunk_bytes=500).collect()} == want
    for most in (1000, 4):
        table = bpe.word_table(df, vocabulary, most=most)
        words = [w for w, n in want.items() if n > 1]
        data = [w.encode() for w in words]
        cuts = np.concatenate([[0], np.cumsum([len(w) for w in data])])
        at = table.find(bpe.word_hashes(np.frombuffer(b"".join(data), np.uint8), cuts[:-1], cuts[1:]))
        assert (at >= 0).sum() == len(table.hashes) == (len(words) if most > 10 else 4)
        for k in np.flatnonzero(at >= 0):
            start = table.starts[at[k]]
            assert table.ids[start : start + table.counts[at[k]]].tolist() == known.encode_ordinary(words[k])


def test_bpe_table(spark):
    rows = [(k, t, None) for k, t in enumerate(TEXTS)] + [(None, "null id", None), (77, None, None), (1, TEXTS[2], None), (78, "long word " * 60000, None)]
    df = documents(spark, rows)
    for size, most in ((bpe.CHUNK_BYTES, bpe.TABLE_WORDS), (100, 10), (bpe.CHUNK_BYTES, 0)):
        got = bpe.encode_decode(df.where("doc_id IS NULL OR doc_id < 78") if size == 100 else df, chunk_bytes=size, table_words=most).collect()
        assert len(got) == len(rows) - (size == 100)
        known = reference_encoding_cached()
        want = Counter((d, None if t is None else tuple(known.encode_ordinary(t))) for d, t, _ in rows if size > 100 or d != 78)
        assert Counter((r["doc_id"], None if r["token_ids"] is None else tuple(r["token_ids"])) for r in got) == want
        assert all(r["decoded_ok"] is (None if r["token_ids"] is None else True) for r in got)
    assert bpe.encode_decode(df.limit(0)).count() == 0


@pytest.mark.parametrize("piece, clash", [(1, False), (5, False), (40, False), (5, True)])
def test_bpe_pieces(monkeypatch, piece, clash):
    monkeypatch.setattr(bpe, "PIECE", piece)
    if clash:  # all words of one hash
        monkeypatch.setattr(bpe, "word_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    known, vocabulary = reference_encoding_cached(), bpe.load_vocabulary()
    texts = [*TEXTS, "the quick brown fox " * 40]
    for flat, cuts, back in bpe.encode_all([pa.array(texts), pa.array(texts[::-1])], vocabulary):
        got = [flat[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])]
        assert sorted(got) == sorted(known.encode_ordinary(t) for t in texts)
        assert bytes(back) in ("".join(texts).encode(), "".join(texts[::-1]).encode())


def test_bpe_memory_of_chunks():
    draw = random.Random(11)
    often = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 8))) for _ in range(5000)]

    def chunk():
        words = [draw.choice(often) if draw.random() < 0.97 else "".join(draw.choices("etaoinshrdlu", k=9)) for _ in range(350_000)]
        return pa.array([" ".join(words[k : k + 500]) for k in range(0, len(words), 500)])

    vocabulary, chunks = bpe.load_vocabulary(), [chunk() for _ in range(bpe.CHUNKS_TOGETHER)]
    size = sum(len(bpe.text_bytes(c)[0]) for c in chunks)
    bpe.encode(chunks[0].slice(0, 1), vocabulary)  # the classes of the code points
    tracemalloc.start()
    try:
        assert all(bytes(back) == bytes(bpe.text_bytes(c)[0]) for c, (_, _, back) in zip(chunks, bpe.encode_all(chunks, vocabulary)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 6 * size


# --- pages


def page(draw, content, marked=True):
    word = lambda: "".join(draw.choices("abcdefgh", k=5))
    a, b, c = ("nav", "article", "footer") if marked else ("div", "div", "div")
    menu = "".join(f"<li><a href='/{word()}'>{word()}</a></li>" for _ in range(6))
    body = "".join(f"<p>{' '.join(x)}.</p>" for x in content)
    return f"<html><head><title>t</title><script>if (a < b) x('</p>')</script></head><body><{a}><ul>{menu}</ul></{a}><div class='ad'>{word()}</div><{b}>{body}</{b}><{c}>&copy; {word()}</{c}>"


def test_extraction_of_held_out_pages(spark):
    draw = random.Random(2)
    contents = [[["".join(draw.choices("klmnopq", k=6)) for _ in range(draw.randint(15, 60))] for _ in range(draw.randint(2, 5))] for _ in range(80)]
    train = spark.createDataFrame([(k, "u", page(draw, c)) for k, c in enumerate(contents[:50])], "page_id bigint, url string, html string")
    model = html.train(train)
    held = spark.createDataFrame([(k, "u", page(draw, c, marked=False), "x") for k, c in enumerate(contents[50:])], "page_id bigint, url string, html string, text string")
    right = sum(r["text"] == "\n".join(" ".join(x) + "." for x in contents[50 + r["page_id"]]) for r in html.extract_pages(held, model).collect())
    assert right >= 28


def test_marginals_against_enumeration():
    draw = np.random.default_rng(5)
    model = html.Model(draw.normal(size=(int(np.prod(html.SHAPE)), 2)), draw.normal(size=(html.N_KINDS, 2, 2)), draw.normal(size=2))
    for source in ("", "<p>a<b>c</b></p>", "<div><p>Hello world.</p><ul><li><a>x</a><li>y</ul>tail</div>"):
        f = html.Forest([html.parse(source)])
        n = len(f.cell)
        total = np.zeros((n, 2))
        for y in itertools.product((0, 1), repeat=n):
            s = model.root[y[0]] + sum(model.node[f.cell[k], y[k]] for k in range(n)) + sum(model.edge[f.kind[k], y[f.parent[k]], y[k]] for k in range(1, n))
            for k in range(n):
                total[k, y[k]] += np.exp(s)
        assert np.allclose(html.marginals(f, model), total[:, 1] / total.sum(1))


def test_broken_pages(spark):
    sources = [None, "", "plain", "<<<<", "a < b <a href=\"x>y\">z</a>", "<div" * 3000, "<div>" * 3000 + "x", "<p>" * 3000 + "x", "<script>never closed <p>x", "<!-- open", "</p></div>x", "&amp;&lt;", "<p>one<p>two<ul><li>a<li>b</ul>", "<a b='\"'>q</a>", "x" * 300000]
    df = spark.createDataFrame([(k, None, s) for k, s in enumerate(sources)] + [(None, "u", "twice"), (2, "u", "plain")], "page_id bigint, url string, html string")
    got = html.extract_pages(df).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == len(sources) + 2 and by[0]["text"] == by[1]["text"] == "" and by[0]["certainty"] is None
    assert by[2]["text"] == "plain" and by[11]["text"] == "&<" and len(by[14]["text"]) == 300000
    assert html.extract_pages(df.limit(0)).count() == 0


@pytest.mark.parametrize("piece", ["<b>", "<p><b>x<h1>", '<a b="x>', "<li><b>", "<div><p>a<b><h2>", "<td><i>", "<", '">', "<script>", "<!--"])
def test_pages_of_one_repeated_sign_take_linear_time(piece):
    took = []
    for n in (40_000, 160_000):
        began = time.perf_counter()
        tree = html.parse(piece * (n // len(piece)))
        took.append(time.perf_counter() - began)
    assert took[1] < 0.3 + 8 * took[0]
    f = html.Forest([tree])
    assert len(f.levels) <= html.MAX_NESTING + 1


def test_deep_text_is_kept():
    even = html.Model(np.zeros((int(np.prod(html.SHAPE)), 2)), np.zeros((html.N_KINDS, 2, 2)), np.zeros(2))
    assert html.extract(["<b>x" * 2000], even)[0]["n_nodes"] == 2000
    assert html.extract(["<ul><li>a<ul><li>b<p>c<li>d</ul>e</ul>"], even)[0]["text"].split() == list("abcde")


# --- sharding


def test_sharding_is_a_seeded_permutation(spark, tmp_path):
    rows = [(k, f"text {k} " * (k % 7), "en") for k in range(3000)] + [(None, None, None), (None, None, None), (5, "x" * 200000, "en")] + [(9, "the same row", "en")] * 3000
    documents(spark, rows).drop("place_").withColumnsRenamed({"n_chars": "a.b", "_verdict": "c`d"}).repartition(7).write.parquet(str(tmp_path / "in"))
    df, seen = spark.read.parquet(str(tmp_path / "in")), []
    for n in (1, 64):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", n)
        one = sharding.shuffled(df, bucket_bytes=8192)
        assert one.columns == [*df.columns, "shard_", "place_"]
        seen.append(one.orderBy("shard_", "place_").collect())
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    got = seen[0]
    assert got == seen[1] and Counter((r["doc_id"], r["text"]) for r in got) == Counter((d, t) for d, t, _ in rows)
    other = sharding.shuffled(df, seed=1, bucket_bytes=8192).orderBy("shard_", "place_").collect()
    assert [r["doc_id"] for r in other] != [r["doc_id"] for r in got]
    sizes = Counter(r["shard_"] for r in got)
    assert all(sorted(r["place_"] for r in got if r["shard_"] == s) == list(range(n)) for s, n in sizes.items())
    expected = len(rows) / sharding.bucket_count(df, 8192)
    assert sum((n - expected) ** 2 / expected for n in sizes.values()) < 2 * len(sizes)
    assert sharding.shuffled(df.limit(0)).count() == sharding.sharded(df.limit(0)).count() == 0
    back = sharding.sharded(df, bucket_bytes=8192)
    assert back.schema == one.schema and back.orderBy("shard_", "place_").collect() == got


def test_buckets_count_all_kinds_of_columns(spark):
    df = spark.createDataFrame([(k, [1.0] * 1000, ("x" * 1000,), {"k": "v" * 500}, None) for k in range(50)], "id int, e array<float>, s struct<a:string>, m map<string,string>, t string")
    assert 50 * 9500 < sharding.bucket_count(df, 1) < 50 * 9800
    assert sharding.shuffled(df, bucket_bytes=50_000).select("shard").distinct().count() > 5


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(sharding.fisher_yates(4, [k, 1]).tolist()) for k in range(6000))
    assert len(seen) == 24 and sum((n - 250) ** 2 / 250 for n in seen.values()) < 60


def test_written_shards(spark, tmp_path):
    df = documents(spark, [(k, "abc", "en") for k in range(200)]).drop("shard", "place_", "Place")
    back = sharding.write_shards(df, str(tmp_path / "s"), bucket_bytes=4096)
    assert back.count() == 200 and back.columns == [*df.columns, "shard", "place"]
    for part in (tmp_path / "s").glob("shard=*"):
        assert spark.read.parquet(str(part)).coalesce(1).select("place").toPandas()["place"].is_monotonic_increasing


def test_words_split_alike():
    from textquarry.llm.words import GAP_PATTERN, fold_text

    for t in ("Ab-c d_e  É.x", "", "...", "a\nb"):
        assert fold_text(t).decode().split() == re.sub(GAP_PATTERN, " ", t.lower()).split()
