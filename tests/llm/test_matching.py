"""Exact, near and substring deduplication, decontamination and secrets against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from textquarry.llm import decontam, exact_dedup, near_dedup, secrets, substrings
from textquarry.llm.words import Words, fold_bytes, fold_text

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = SCHEMA + ", _rid string, seed string, shard int, _old int, _hits string, _RID_ int, duplicate_of string"


def table(spark, rows, schema=SCHEMA):
    wide = len(schema.split(",")) - 5
    return spark.createDataFrame([(d, t, "en", s, None, *[None] * wide) for d, t, s in rows], schema)


def words_of(draw, n, size=5000):
    return [f"w{draw.randint(0, size)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Random documents with copies, near copies, shared passages, nulls, empty, short and long texts, equal ids."""
    draw = random.Random(11)
    rows = []
    passage = words_of(draw, 70)
    for k in range(60):
        w = words_of(draw, draw.randint(1, 250))
        rows.append((k, " ".join(w), f"s{k % 4}"))
        if k % 5 == 0:
            rows.append((100 + k, " ".join(w), f"s{k % 3}"))
        if k % 6 == 0:
            v = list(w)
            for at in range(7, len(v), 40):
                v[at] = "changed"
            rows.append((200 + k, " ".join(v).upper() + "!", "s1"))
        if k % 7 == 0:
            rows.append((300 + k, " ".join([*words_of(draw, 40), *passage[k % 3 :], *words_of(draw, 30)]), "s2"))
    rows += [(400, None, "s1"), (401, None, None), (402, "", "s0"), (403, "", "s1"), (404, "...", "s2"), (405, "...", "s3"), (None, "lonely words here", "s1"), (None, "lonely words here", None), (7, rows[7][1], rows[7][2])]
    long = words_of(draw, 30_000)
    rows += [(500, " ".join(long), "s0"), (501, " ".join(long[100:29_000]), "s3")]
    draw.shuffle(rows)
    return rows


def shingles(text, width):
    w = fold_text(text).split()
    return {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()


def test_exact_against_brute_force(spark, corpus):
    got = [(r["doc_id"], r["duplicate_of"]) for r in exact_dedup.exact_repeats(table(spark, corpus)).collect()]
    groups = {}
    for d, t, s in corpus:
        if t is not None:
            groups.setdefault(t, []).append((not (s is not None and s <= "s1"), d is None, d or 0, d))
    want = []
    for some in groups.values():
        some.sort(key=lambda x: x[:3])
        want += [(x[3], some[0][3]) for x in some[1:]]
    key = lambda p: tuple((x is None, x or 0) for x in p)
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = exact_dedup.drop_exact_repeats(table(spark, corpus, EXTRA))
    assert kept.count() == len(corpus) - len(want)


def test_perfect_hash_is_minimal_and_knows_strangers():
    draw = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        keys = draw.integers(0, 256, (n, 32)).astype(np.uint8)
        mph = exact_dedup.PerfectHash.build(keys)
        assert sorted(mph.find(keys).tolist()) == list(range(n))


def test_super_min_hash_against_the_sequential_walk():
    draw = np.random.default_rng(2)
    docs = [draw.integers(0, 2**63, n).astype(np.uint64) for n in (0, 1, 3, 50, 400)]
    cuts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    got = near_dedup.signatures(np.concatenate(docs), cuts)
    slots = near_dedup.SLOTS
    for d, row in zip(docs, got):
        best = [0xFFFFFFFF] * slots
        for x in d:
            p = list(range(slots))
            for j in range(slots):
                r = int(near_dedup.mix64(np.array([x], np.uint64) + np.uint64((j + 1) * near_dedup._STEP % (1 << 64)))[0])
                k = j + (((r & 0xFFFFFFFF) * (slots - j)) >> 32)
                p[j], p[k] = p[k], p[j]
                best[p[j]] = min(best[p[j]], (r >> 39) | (j << 25))
        assert row.tolist() == best


def test_signature_estimates_jaccard():
    draw = np.random.default_rng(3)
    errors = []
    for k in range(60):
        pool = draw.integers(0, 2**63, 500).astype(np.uint64)  # trials on one pool would err together
        a, b = pool[: 300 + k], pool[100 : 400 + 2 * k]
        s = near_dedup.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        true = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
        errors.append((s[0] == s[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_near_groups_against_brute_force(spark, corpus):
    got = {}
    for r in near_dedup.near_duplicates(table(spark, corpus)).collect():
        got.setdefault(r["group_id"], []).append((r["doc_id"], r["kept"], r["group_size"]))
    texts = [(d, t) for d, t, _ in corpus]
    sets = [shingles(t, near_dedup.SHINGLE) for _, t in texts]
    top = list(range(len(texts)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both / (len(sets[i]) + len(sets[j]) - both) >= near_dedup.THRESHOLD:
                top[root(i)] = root(j)
    want = {}
    for i, (d, _) in enumerate(texts):
        want.setdefault(root(i), []).append(d)
    want = [sorted(v, key=lambda d: (d is None, d)) for v in want.values() if len(v) > 1]
    found = [sorted((d for d, _, _ in v), key=lambda d: (d is None, d)) for v in got.values()]
    key = lambda v: [(-1 if d is None else d) for d in v]
    assert sorted(found, key=key) == sorted(want, key=key)
    for head, members in got.items():
        assert [d for d, kept, _ in members if kept] == [head] and {n for _, _, n in members} == {len(members)}
    kept = near_dedup.keep_one(table(spark, corpus, EXTRA))
    assert kept.count() == len(corpus) - sum(len(v) - 1 for v in want)
    assert {r["doc_id"] for r in kept.where("text IS NULL OR text = ''").collect()} == {400, 401, 402, 403}


def test_members_that_fail_against_the_smallest_meet_the_others(spark):
    """b and c are near copies, a only shares a band with them: the group must not depend on a being the smallest."""
    draw = random.Random(5)
    a = words_of(draw, 200)
    b = a[:120] + words_of(draw, 90)
    c = b[:205] + ["x"] * 5
    docs = table(spark, [(1, " ".join(a), "s"), (2, " ".join(b), "s"), (3, " ".join(c), "s")])
    assert sorted(r["doc_id"] for r in near_dedup.near_duplicates(docs).collect()) == [2, 3]


def repeated_words(rows, length=substrings.LENGTH):
    """words removed, what stays, and the ids of the first holders, of every row with repeats, by brute force."""
    first, want = {}, []
    for k, r in enumerate(rows):
        w = fold_text(r["text"]).split()
        covered, holders = [False] * len(w), set()
        for i in range(len(w) - length + 1):
            held = first.setdefault(tuple(w[i : i + length]), k)
            if held < k:
                covered[i : i + length] = [True] * length
                holders.add(held)
        if any(covered):
            ids = sorted({rows[h]["doc_id"] for h in holders} - {None})
            want.append((sum(covered), b" ".join(x for x, c in zip(w, covered) if not c), ids))
    return sorted(want)


@pytest.fixture(scope="module")
def overlapping(corpus):
    """The corpus, and passages that overlap in part, so that windows of one span have several first holders."""
    draw = random.Random(12)
    pool = words_of(draw, 400)
    rows = list(corpus)
    for k in range(40):
        a = draw.randint(0, 300)
        parts = [pool[a : a + draw.randint(50, 100)]]
        if k % 3 == 0:
            b = draw.randint(0, 300)
            parts.append(pool[b : b + 80])
        rows.append((600 + k, " ".join([*words_of(draw, 5), *[w for p in parts for w in p], *words_of(draw, 5)]), "s1"))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [substrings.HOT_SEED, 3, 0])
def test_substrings_against_brute_force(spark, overlapping, hot):
    docs = table(spark, overlapping, EXTRA).repartition(3).cache()
    rows = exact_dedup.with_row_id(docs.select("doc_id", "text")).orderBy("_rid").collect()
    want = repeated_words(rows)
    assert any(len(ids) > 2 for _, _, ids in want)
    got = substrings.cut_repeats(docs, shard_words=2000, hot=hot).collect()
    assert sorted((r["words_removed"], b" ".join(fold_text(r["text"]).split()), r["found_in"]) for r in got) == want


def thue_morse(n, a, b):
    out = [a]
    while len(out) < n:
        out += [b if x == a else a for x in out]
    return out


def test_texts_that_collide_under_polynomial_hashes_are_told_apart(spark):
    rows = [(1, " ".join(thue_morse(4096, "foo", "bar")), "s"), (2, " ".join(thue_morse(4096, "bar", "foo")), "s"), (3, "".join(thue_morse(4096, "a", "b")), "s"), (4, "".join(thue_morse(4096, "b", "a")), "s")]
    docs = table(spark, rows)
    a, b = near_dedup.near_edges(exact_dedup.with_row_id(docs.select("doc_id", "text"))), {}
    for t in docs.collect():
        w = fold_text(t["text"]).split()
        b[t["doc_id"]] = {tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))}
    assert b[1] == b[2]  # the same shingles: near copies, but by comparison and not by an equal hash
    assert a.count() == 1
    assert near_dedup.keep_one(docs).count() == 3
    held = substrings.cut_repeats(docs).collect()
    want = repeated_words(sorted(docs.collect(), key=lambda r: r["doc_id"]))
    assert sorted((r["words_removed"], b" ".join(fold_text(r["text"]).split()), r["found_in"]) for r in held) == want
    x = np.frombuffer((" " + "".join(thue_morse(4096, "a", "b")) + " \n " + "".join(thue_morse(4096, "b", "a")) + " \n").encode(), np.uint8)
    w = Words(*fold_bytes(x, np.array([0, len(x) // 2, len(x)])))
    assert len(set(w.hashes.tolist())) == 2 and len(set(w.digests())) == 2


def test_locators_don_t_depend_on_how_a_scan_is_split(spark, tmp_path):
    table(spark, [(k, f"text {k}", "s") for k in range(200)]).repartition(6).write.parquet(str(tmp_path / "six"))
    docs, seen = spark.read.parquet(str(tmp_path / "six")), []
    before = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
    for n in (1, 64):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", n)
        seen.append({r["doc_id"]: r["_rid"] for r in exact_dedup.with_row_id(docs.where("doc_id > 3")).collect()})
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism") if before is None else spark.conf.set("spark.sql.leafNodeDefaultParallelism", before)
    assert seen[0] == seen[1] and len(set(seen[0].values())) == 196


def test_without_broadcasts_results_are_the_same(spark, corpus):
    docs = table(spark, corpus).repartition(3).cache()
    key = lambda r: repr(r)
    every = lambda: [sorted(map(key, f(docs).collect())) for f in (exact_dedup.exact_repeats, exact_dedup.drop_exact_repeats, near_dedup.near_duplicates, near_dedup.keep_one, substrings.cut_repeats)]
    small = every()
    spark.conf.set("textquarry.broadcast.bytes", "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert every() == small
    finally:
        spark.conf.unset("textquarry.broadcast.bytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("few", [near_dedup.FEW_FAILED, 0])
def test_a_bucket_of_one_template(spark, few):
    """Pages of one template, below the threshold from each other, with two similar ones among them."""
    draw = random.Random(13)
    common = words_of(draw, 180)
    rows = [(k, " ".join([*common, *words_of(draw, 150, 10**9)]), "s") for k in range(150)]
    rows.append((500, rows[77][1] + " and so on", "s"))
    docs = exact_dedup.with_row_id(table(spark, rows).select("doc_id", "text")).cache()
    names = {r["_rid"]: r["doc_id"] for r in docs.collect()}
    sets = docs.select("_rid", near_dedup._shingle_set(near_dedup.framed()).alias("set"))
    pairs = near_dedup.prefix_pairs(sets.selectExpr("_rid", "set", "true AS lost"), near_dedup.THRESHOLD)
    assert pairs.count() < 20  # of 11,325
    edges = near_dedup.near_edges(docs, few=few).collect()
    assert [sorted((names[r["src"]], names[r["dst"]])) for r in edges] == [[77, 500]]


def test_prefix_pairs_miss_no_similar_pair(spark):
    draw = random.Random(14)
    rows = []
    for k in range(60):
        w = words_of(draw, draw.choice((1, 2, 3, 5, 20, 60)), 12)
        rows += [(3 * k, " ".join(w), "s"), (3 * k + 1, " ".join(w[: len(w) * 3 // 4 + 1]), "s"), (3 * k + 2, " ".join(w[1:]), "s")]
    docs = exact_dedup.with_row_id(table(spark, rows).select("doc_id", "text")).where("text <> ''").cache()
    sets = docs.select("_rid", near_dedup._shingle_set(near_dedup.framed()).alias("set"))
    for threshold in (0.5, 0.7, 1.0):
        got = {(r["src"], r["dst"]) for r in near_dedup.prefix_pairs(sets.selectExpr("_rid", "set", "true AS lost"), threshold).collect()}
        held = [(r["_rid"], shingles(r["text"], near_dedup.SHINGLE)) for r in docs.collect()]
        want = {(max(a, b), min(a, b)) for a, x in held for b, y in held if a != b and len(x & y) / len(x | y) >= threshold}
        assert want and not want - got


def test_automaton_against_brute_force():
    draw = random.Random(9)
    known = [[draw.randint(0, 3) for _ in range(draw.randint(0, 40))] for _ in range(6)]
    a = substrings.Automaton()
    for k, w in enumerate(known):
        a.extend(w, k)
    for _ in range(20):
        t = [draw.randint(0, 4) for _ in range(50)]
        for most in (None, 3, 1):
            sizes, owners = a.statistics(t, most)
            for i in range(len(t)):
                holds = lambda n, w: any(w[j : j + n] == t[i - n + 1 : i + 1] for j in range(len(w) - n + 1))
                best = max((n for n in range(1, min(i + 1, most or 99) + 1) if any(holds(n, w) for w in known)), default=0)
                assert sizes[i] == best
                if best:
                    assert owners[i] == next(k for k, w in enumerate(known) if holds(best, w))


@pytest.fixture(scope="module")
def leaking(corpus):
    """Documents and benchmark items, some shorter than a test string, that stand in them whole, in part or as a line."""
    draw = random.Random(4)
    items = [(k, " ".join(words_of(draw, n))) for k, n in enumerate((3, 5, 9, 10, 11, 30, 60))] + [(50, None), (None, "a b c d e f g"), (51, ""), (52, "tie tie tie tie tie tie"), (53, "tie tie tie tie tie tie"), (54, "Yes!"), (55, "..."), (56, "yes")]
    docs = [(d, t, s) for d, t, s in corpus[:40]]
    docs += [(900 + k, f"before, {t.upper()}; after", "s") for k, (_, t) in enumerate(items) if t] + [(950, "tie-tie " * 20, "s"), (951, " ".join(items[6][1].split()[20:31]), "s")]
    docs += [(960, f"a line\n  {items[0][1].upper()}.\nanother", "s"), (961, "yes", "s"), (961, "yes", "s"), (962, "well yes\nof course", "s"), (963, "\n\n YES \r\nyes\nno", "s"), (964, "no\n-yes", "s")]
    return docs, items


def test_leaks_against_brute_force(spark, leaking):
    docs, items = leaking
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id bigint, text string, _hits int")
    want = {}
    for n, (d, t, _) in enumerate(docs):
        for i, item in items:
            if i is None or t is None or not fold_text(item).split():
                continue
            w = fold_text(item).split()
            if len(w) < decontam.LINE_WORDS:
                runs = {b" ".join(w)} & {b" ".join(fold_text(line).split()) for line in t.split("\n")}
            else:
                runs = {r for r in (b" " + b" ".join(w[k : k + decontam.NGRAM]) + b" " for k in range(max(1, len(w) - decontam.NGRAM + 1))) if r in fold_text(t)}
            if runs:
                want[n, d, i] = len(runs)
    key = lambda rows: sorted(rows, key=repr)
    for limit in (decontam.PATTERN_BYTES, 2000, 200):
        got = [(r["doc_id"], r["item_id"], r["windows"]) for r in decontam.leaks(table(spark, docs, EXTRA), bench, limit=limit).collect()]
        assert key(got) == key((d, i, c) for (_, d, i), c in want.items())
        assert decontam.drop_leaks(table(spark, docs, EXTRA), bench, limit=limit).count() == len(docs) - len({n for n, _, _ in want})
    assert decontam.leaks(table(spark, docs), bench.limit(0)).count() == 0 and decontam.drop_leaks(table(spark, docs), bench.limit(0)).count() == len(docs)
    assert len(list(decontam.searchers(bench, limit=200))) > 3


def test_leaks_against_sql(spark, leaking, tmp_path):
    from compare import oracle_rows, spark_rows

    from textquarry.llm import queries as llm

    docs, items = leaking
    for name, df in (("documents", table(spark, docs)), ("benchmark", spark.createDataFrame(items, "item_id bigint, text string"))):
        df.coalesce(1).write.parquet(str(tmp_path / "parts" / name))
        next((tmp_path / "parts" / name).glob("*.parquet")).rename(tmp_path / f"{name}.parquet")
    for name in ("op4_exact_dedup", "op6_decontamination"):
        assert spark_rows(llm.queries()[name](spark, str(tmp_path))) == oracle_rows(str(tmp_path), llm.oracle_sql()[name])


def test_texts_are_searched_once(spark, leaking):
    docs, items = leaking
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for df in (decontam.leaks(table(spark, docs), bench), secrets.secrets(table(spark, docs))):
        assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_lines_fold_like_texts():
    draw = random.Random(15)
    texts = ["".join(draw.choices("aB.\n \ré", k=draw.randint(0, 30))) for _ in range(300)]
    framed = [f" {t.lower()} \n".encode() for t in texts]
    data, cuts = np.frombuffer(b"".join(framed), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in framed])])
    x, own = decontam.fold_lines(data, cuts)
    for k, t in enumerate(texts):
        lines = [b" ".join(fold_text(line).split()) for line in t.split("\n")]
        assert x[own[k] : own[k + 1]].tobytes().split(b"\n") == [b"", *filter(None, lines), b""] or not any(lines)


def test_secrets(spark):
    draw = random.Random(6)
    key = "".join(draw.choice("0123456789abcdef") for _ in range(40))
    rows = [
        (1, f'x token = "{key}" y', "s"),
        (2, "token = get_password_from_settings() and token_validator validate_token", "s"),
        (3, f"plain {key} without a word beside it", "s"),
        (4, "password: aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "s"),
        (5, None, "s"),
        (6, "", "s"),
        (7, f"secret: {key} and again secret: {key}", "s"),
        (7, f"é api_key={key[:20]}", "s"),
        (8, "word " * 20000 + f"Authorization: Bearer {key}", "s"),
        (None, f"pwd={key}", "s"),
    ]
    got = secrets.secrets(table(spark, rows, EXTRA)).collect()
    texts = {}
    for d, t, _ in rows:
        texts.setdefault(d, []).append(t)
    assert sorted((r["doc_id"] or 0) for r in got) == [0, 1, 7, 7, 7, 8]
    assert all(any(t[r["start"] : r["end"]] in (key, key[:20]) for t in texts[r["doc_id"]]) and r["novelty"] >= secrets.MIN_NOVELTY for r in got)


def test_secrets_in_many_forms(spark):
    draw = random.Random(3)
    key = "".join(draw.choice("0123456789abcdef") for _ in range(40))
    basic, short, odd = "dXNlcjpYeDcjS3EhMm1aOTkw+Q==", "x7#Kq!2mZ", "a!4h8f69k9ReBaMd688GQ8"
    forms = [
        ('SECRET_KEY = "{}"', key),
        ('secretKey: "{}"', key),
        ('API_KEY_PROD = "{}"', key),
        ('setPassword("{}")', key),
        ("setPassword({})", key),
        ("Authorization: Basic {}", basic),
        ('token = b"{}"', key),
        ('password = os.getenv("P", "{}")', key),
        ('"{}"  # the token', key),
        ('password = "{}"', short),
        ('password = "{}"', odd),
        ("password={}", odd),
        ('{{"password":"{}","user":"bob"}}', short),
        ("https://h.example.com/p?api_key={}&x=1", key),
        ("password={}", "x7(Kq&2mZ"),
        ('password = "{}"', "xkqzvbnm"),
        ('token = "{0}"' + " it" * 18 + ' token = "{0}"', key),
    ]
    rows = [(k, f"one line before\n{form.format(value)}\none after it", "s") for k, (form, value) in enumerate(forms)]
    clean = [
        "The secret of the Mississippi expedition, 1894-95, was the passenger who kept the passwords.",
        "token = lexer.next()",
        "def login(self, username: str, password: str) -> Optional[Token]:",
        'password = os.environ["DB_PASSWORD"]',
        'token = jwt.encode(payload, SECRET_KEY, algorithm="HS256")',
        "token expires 2024-01-15T10:00:00Z",
    ]
    rows += [(100 + k, t, "s") for k, t in enumerate(clean)]
    got = sorted((r["doc_id"], rows[r["doc_id"]][1][r["start"] : r["end"]] if r["doc_id"] < 100 else "") for r in secrets.secrets(table(spark, rows)).collect())
    assert got == [(k, value) for k, (form, value) in enumerate(forms) for _ in range(1 + ("{0}" in form))]


@pytest.mark.parametrize("alphabet", ["0123456789abcdef", "0123456789ABCDEF", "0123456789", "01", "acgt", "abcdefghijklmnopqrstuvwxyz"])
def test_long_secrets_of_small_alphabets(alphabet):
    draw, novelty = random.Random(8), secrets.Novelty()
    for length in (64, 96, 128, 256, 512):
        for form in ('x = 3\nSECRET_KEY = "{}"\ny = 4', "ein Text und token={} und mehr davon"):
            key = "".join(draw.choice(alphabet) for _ in range(length))
            text = form.format(key)
            assert [text[r["start"] : r["end"]] for r in secrets.scan(text, novelty)] == [key]


def test_secrets_are_measured_with_the_words_of_the_whole_text():
    novelty, far = secrets.Novelty(), "\nx = 1" * 60 + "\n"
    names = "class CustomerSession(Base): ...\nclass ValidatorFactory(Base): ...\nclass InternalOrder(Base): ...\nclass RepositoryAdapter(Base): ...\n"
    for value in ("CustomerSessionValidatorFactory", "InternalOrderRepositoryAdapter"):
        assert secrets.scan(f'token = "{value}"', novelty)
        assert not secrets.scan(f'{names}{far}token = "{value}"{far}', novelty), value
    for value in ("xkqzvbnmwrtp", "a!Kqzvbnm#Wrtpsdf"):  # copies of a secret are no words of the text
        text = f'{names}{value}{far}{value}{far}password = "{value}"{far}{value}'
        assert [text[r["start"] : r["end"]] for r in secrets.scan(text, novelty)] == [value]


def test_long_strings_that_are_not_random():
    novelty = secrets.Novelty()
    for value in ("0" * 200, "0123456789abcdef" * 8, "deadbeef" * 16, "ab" * 100, "/usr/local/bin/example/config/settings/default/options/access_token/password_hash"):
        assert not secrets.scan(f'token = "{value}"', novelty), value


def test_identifiers_of_the_corpus_are_known(spark):
    """Names that other documents use are no secrets; a key is one however many documents repeat it."""
    draw = random.Random(16)
    key = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=24))
    rows = [(k, f"the quick_brown fox_jumps over it and CustomerSession or ValidatorFactory {k}", "s") for k in range(20)]
    rows += [(100, "token = the_quick_brown_fox_jumps_over", "s"), (101, 'token = "CustomerSessionValidatorFactory"', "s")]
    rows += [(200 + k, f'password = "{key}"', "s") for k in range(30)]
    docs = table(spark, rows)
    known = secrets.corpus_identifiers(docs)
    assert {"quick_brown", "fox_jumps", "CustomerSession", "ValidatorFactory", "password"} <= set(known)
    counts = {}
    for _, t, _ in rows:
        for w in secrets._WORD.findall(t):
            counts[w] = counts.get(w, 0) + 1
    assert known == sorted((w for w, n in counts.items() if n > 1), key=lambda w: (counts[w], w))
    assert sorted(r["doc_id"] for r in secrets.secrets(docs).collect()) == list(range(200, 230))
    assert {r["doc_id"] for r in secrets.secrets(docs, identifiers=[]).collect()} >= {100, 101}


def test_cost_is_the_difference_of_two_sizes():
    """Marginal bytes against compressing both texts anew, and planted keys against names made of the text's words."""
    import zstandard

    draw, novelty = random.Random(17), secrets.Novelty(corpus=["alpha_beta", "gamma"])
    found = clean = 0
    for k in range(60):
        before, after = " ".join(words_of(draw, 8)).encode(), " ".join(words_of(draw, 8)).encode()
        value = "".join(draw.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789", k=draw.randint(16, 60))).encode()
        dictionary = "alpha_beta gamma\n".encode() + secrets.IDENTIFIERS.encode() + b"known words\n" + before + b"\n" + after
        size = lambda x: len(zstandard.ZstdCompressor(level=9, dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False).compress(x))
        cost, usual = novelty.cost(before, value, after, b"known words")
        assert abs(cost - (size(before[-16:] + value + after[:16]) - size(before[-16:] + after[:16]))) <= 2
        text = f"{before.decode()} session_store request_handler api_key = {value.decode()} {after.decode()}"
        found += [text[r["start"] : r["end"]] for r in secrets.scan(text, novelty)] == [value.decode()]
        name = "_".join(draw.sample(["session_store", "request_handler", "alpha_beta", "gamma"], 3))
        clean += not secrets.scan(f"{text[:40]} session_store request_handler api_key = {name} {after.decode()}", novelty)
    assert found == 60 and clean >= 57


def test_empty_tables(spark):
    none = table(spark, [(1, "x", "s")]).limit(0)
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert exact_dedup.exact_repeats(none).count() == exact_dedup.drop_exact_repeats(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == near_dedup.keep_one(none).count() == 0
    assert substrings.cut_repeats(none).count() == secrets.secrets(none).count() == decontam.leaks(none, bench).count() == 0


def test_span_marks_follow_the_folding():
    for t in ("Ein Ärger—über 3 Äpfel", "a_b-c d", "İstanbul K x", "", "..."):
        assert len(substrings.word_marks(t)) == len(fold_text(t).split())
