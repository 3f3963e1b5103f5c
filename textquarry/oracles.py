"""DuckDB SQL of the standing queries."""

from __future__ import annotations

import unicodedata

import numpy as np

from textquarry.functions.lexicons import BAD_WORDS, CATEGORIES, DOMAIN_CATEGORIES, STOP_WORDS

#: Patterns, band shapes and permutations are spelled out here, so that a wrong one in the operators shows.
WORD = r"[\p{L}\p{N}_]"
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
RAW_WORD = rf"{WORD}+|[^\p{{L}}\p{{N}}_{SPACE}]+"
LINE = r"[^\n]*\n|[^\n]+"
SENTENCE = rf"[^.!?]*{WORD}[^.!?]*"
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
BULLETS = "•‣▶◀◦■□▪▫–"
BANDS = {0.7: (14, 9), 0.8: (9, 13), 0.9: (5, 25), 1.0: (1, 128)}
BUCKETS = 10_000


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def nfd(expr: str) -> str:
    """Decomposition of the Latin letters that lower-cased texts hold, as nested replacements."""
    for code in range(0xE0, 0x180):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and chr(code).lower() == chr(code):
            expr = f"replace({expr}, {q(chr(code))}, {q(parts)})"
    return expr


def plain_norm(c: str) -> str:
    return f"trim(regexp_replace(lower(translate({c}, {q(PUNCTUATION)}, '')), '[{SPACE}]+', ' ', 'g'))"


def split_words(c: str) -> str:
    return f"(CASE WHEN {c} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split({c}, ' ') END)"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


BASE = f"""base AS (SELECT doc_id, text, lang, source, n_chars, {nfd(plain_norm("text"))} AS norm,
    regexp_extract_all(text, {q(RAW_WORD)}) AS rw, regexp_extract_all(text, {q(LINE)}) AS ln FROM documents),
  docs AS (SELECT *, {split_words("norm")} AS nw FROM base)"""
LINES = f"""WITH {BASE},
  flat AS (SELECT doc_id, unnest(ln) AS line, generate_subscripts(ln, 1) - 1 AS line_no FROM docs),
  spans AS (SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line, CAST(sum(length(line)) OVER (PARTITION BY doc_id ORDER BY line_no) AS BIGINT) AS end_pos FROM flat)"""


def doc(expr: str, name: str = "score", kind: str = "DOUBLE") -> str:
    return f"WITH {BASE} SELECT doc_id, CAST({expr} AS {kind}) AS {name} FROM docs"


def ratio(part: str, whole: str, none: str = "NULL") -> str:
    return f"round(CASE WHEN {whole} > 0 THEN ({part}) / CAST({whole} AS DOUBLE) ELSE {none} END, 8)"


def line(expr: str) -> str:
    return f"{LINES} SELECT doc_id, line_no, end_pos - length(line) AS start_pos, end_pos, round(CAST({expr} AS DOUBLE), 8) AS score FROM spans"


def grams(words: str, n: int, table: str = "docs") -> str:
    """doc_id, pos (from 1), gram, of a table that has lists of words."""
    return f"SELECT doc_id, i AS pos, array_to_string({words}[i:i + {n - 1}], ' ') AS gram, {words}[i:i + {n - 1}] AS parts FROM (SELECT doc_id, {words}, unnest(range(1, len({words}) - {n} + 2)) AS i FROM {table})"


def listed(words) -> str:
    return "(" + ", ".join(q(w) for w in words) + ")"


def bad_words() -> str:
    out = "0"
    for lang, phrases in sorted(BAD_WORDS.items()):
        parts = []
        for n in sorted({1 + p.count(" ") for p in phrases}):
            some = listed(p for p in phrases if 1 + p.count(" ") == n)
            parts.append(f"len(list_filter(range(1, len(nw) - {n} + 2), lambda i: array_to_string(nw[i:i + {n - 1}], ' ') IN {some}))")
        out = f"CASE WHEN lang = {q(lang)} THEN {' + '.join(parts)} ELSE {out} END"
    return out


def stop_words() -> str:
    out = "NULL"
    for lang, words in sorted(STOP_WORDS.items()):
        out = f"CASE WHEN lang = {q(lang)} THEN len(list_filter(rw, lambda w: w IN {listed(words)})) ELSE {out} END"
    return f"CASE WHEN len(nw) = 0 THEN 0.0 ELSE round(({out}) / CAST(len(rw) AS DOUBLE), 8) END"


def little_endian(hexed: str, size: int) -> str:
    return "CAST('0x' || " + " || ".join(f"substr({hexed}, {2 * k - 1}, 2)" for k in range(size, 0, -1)) + " AS UBIGINT)"


def bucket(gram: str, buckets: int = BUCKETS) -> str:
    return f"CAST(CAST('0x' || substr(md5({gram}), 1, 8) AS UBIGINT) % {buckets} AS INTEGER)"


FEATURES = f"""WITH raw AS (SELECT doc_id, regexp_extract_all(text, {q(RAW_WORD)}) AS rw FROM documents),
  one AS ({grams("rw", 1, "raw")}), two AS ({grams("rw", 2, "raw")}),
  feats AS (SELECT doc_id, {bucket("gram")} AS bucket FROM (SELECT doc_id, gram FROM one UNION ALL SELECT doc_id, gram FROM two))"""
MODELS = f"""{FEATURES},
  good AS (SELECT doc_id FROM labels WHERE quality = 1),
  pm AS (SELECT bucket, count(*) AS cnt FROM feats WHERE doc_id IN (SELECT doc_id FROM good) GROUP BY bucket),
  qm AS (SELECT bucket, count(*) AS cnt FROM feats GROUP BY bucket),
  pq AS (SELECT coalesce(p.bucket, q.bucket) AS bucket, coalesce(p.cnt, 0) / CAST((SELECT sum(cnt) FROM pm) AS DOUBLE) AS p, coalesce(q.cnt, 0) / CAST((SELECT sum(cnt) FROM qm) AS DOUBLE) AS q FROM pm p FULL JOIN qm q ON p.bucket = q.bucket),
  lr AS (SELECT bucket, ln(p + 1e-8) - ln(q + 1e-8) AS lr FROM pq)"""


def top_gram(n: int) -> str:
    return f"""WITH {BASE}, g AS ({grams("nw", n)}),
  c AS (SELECT doc_id, gram, count(*) AS cnt, min(pos) AS first, min(length(replace(gram, ' ', ''))) AS chars FROM g GROUP BY doc_id, gram),
  t AS (SELECT doc_id, cnt, chars FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cnt DESC, first) = 1)
SELECT d.doc_id, round(CASE WHEN t.cnt > 1 THEN t.chars * t.cnt / CAST(length(replace(norm, ' ', '')) AS DOUBLE) ELSE 0.0 END, 8) AS score FROM docs d LEFT JOIN t ON d.doc_id = t.doc_id"""


def dupe_gram(n: int) -> str:
    return f"""WITH {BASE}, g AS ({grams("nw", n)}),
  m AS (SELECT doc_id, pos FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
  p AS (SELECT DISTINCT doc_id, pos + o AS pos FROM m, (SELECT unnest(range(0, {n})) AS o)),
  s AS (SELECT p.doc_id, sum(length(nw[p.pos])) AS chars FROM p JOIN docs d ON p.doc_id = d.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, round(CASE WHEN length(replace(norm, ' ', '')) > 0 THEN coalesce(s.chars, 0) / CAST(length(replace(norm, ' ', '')) AS DOUBLE) ELSE 0.0 END, 8) AS score FROM docs d LEFT JOIN s ON d.doc_id = s.doc_id"""


def permutation_rows(n: int) -> str:
    draw, top = np.random.RandomState(42), (1 << 61) - 1
    pairs = [(int(draw.randint(1, top, dtype=np.uint64)), int(draw.randint(0, top, dtype=np.uint64))) for _ in range(n)]
    return "VALUES " + ", ".join(f"({k}, {a}::HUGEINT, {b}::HUGEINT)" for k, (a, b) in enumerate(pairs))


def minhash(n: int) -> str:
    return f"""WITH RECURSIVE {BASE}, g AS ({grams("nw", 13)}),
  h AS (SELECT DISTINCT doc_id, {little_endian("s", 4)}::HUGEINT AS h FROM (SELECT doc_id, sha1(gram) AS s FROM g)),
  perms(j, a, b) AS ({permutation_rows(n)}),
  sig AS (SELECT doc_id, j, min((((h * a + b) % 18446744073709551616) % 2305843009213693951) % 4294967296)::BIGINT AS v FROM h, perms GROUP BY doc_id, j)"""


def banded(threshold: float) -> str:
    bands, rows = BANDS[threshold]
    return f"""{minhash(bands * rows)},
  bands AS (SELECT doc_id, CAST(j // {rows} AS INTEGER) AS band, string_agg(printf('%08X', v), '' ORDER BY j) AS key FROM sig GROUP BY doc_id, j // {rows})"""


def edges(threshold: float) -> str:
    return f"""{banded(threshold)},
  low AS (SELECT band, key, min(doc_id) AS dst FROM bands GROUP BY band, key HAVING count(*) > 1),
  edges AS (SELECT DISTINCT b.doc_id AS src, l.dst FROM bands b JOIN low l ON b.band = l.band AND b.key = l.key WHERE b.doc_id <> l.dst)"""


def cluster(threshold: float) -> str:
    return f"""{edges(threshold)},
  both_ways AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
  reach(node, seen) AS (SELECT DISTINCT src, src FROM both_ways UNION SELECT r.node, e.dst FROM reach r JOIN both_ways e ON r.seen = e.src),
  comp AS (SELECT node, min(seen) AS cluster_id FROM reach GROUP BY node)"""


HOST = "regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)"
PATHS = """paths AS (SELECT doc_id, concat('2023-', lpad(CAST(1 + doc_id % 50 AS VARCHAR), 2, '0'), '/', lpad(CAST(doc_id % 7 AS VARCHAR), 4, '0'), '/', lang, '_', CASE doc_id % 3 WHEN 0 THEN 'head' WHEN 1 THEN 'middle' ELSE 'tail' END, '.json.gz') AS path FROM documents)"""
DOMAINS = "VALUES " + ", ".join(f"({q(d)}, {q(c)})" for d, c in DOMAIN_CATEGORIES)

FLAT = f"regexp_replace(text, {q(BREAK)}, ' ', 'g')"
CATEGORY_SETS = f"""cats(c) AS (VALUES {", ".join(f"({q(c)})" for c in CATEGORIES)}),
  combos AS (SELECT [c] AS s FROM cats UNION ALL SELECT list_append(s, c) AS s FROM combos, cats WHERE c > s[-1]),
  idx AS (SELECT CAST(row_number() OVER (ORDER BY len(s), s) - 1 AS INTEGER) AS category_id, array_to_string(s, ',') AS categories FROM combos)"""
ELLIPSIS_END = rf"(\.\.\.|…)[{SPACE}]*$"


def oracle_sql() -> dict[str, str]:
    lgam = "(n_chars * ln({0}) - {0} - lgamma(n_chars + 1))"
    sql = {
        "scan_limit": "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 25",
        "source_pruning": f"WITH {PATHS} SELECT doc_id, path, regexp_extract(path, '/([a-z]{{2}})_[a-z]+\\.json\\.gz$', 1) AS language FROM paths WHERE regexp_full_match(path, '.*/(en|de)_(head|middle)\\.json\\.gz')",
        "head_middle_listing": f"WITH {PATHS} SELECT doc_id, path FROM paths WHERE path LIKE '%head.json.gz' OR path LIKE '%middle.json.gz'",
        "token_listing": f"WITH {PATHS} SELECT doc_id, path, substr(path, 1, 7) AS snapshot_id, substr(path, 9, 4) AS shard_id, regexp_extract(path, '([a-z]+_[a-z]+)\\.json', 1) AS lang_bucket FROM paths WHERE path LIKE '2023-11/%'",
        "snapshot_extract": f"WITH {PATHS} SELECT doc_id, substr(path, 1, 7) AS snapshot_id, path AS uri_id FROM paths",
        "bucket_code": "SELECT doc_id, CAST(CASE doc_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 END AS DOUBLE) AS score FROM documents",
        "jsonl_round_trip": "SELECT doc_id, sha1(text) AS text_hash, lang AS language, n_chars AS length FROM documents",
        "partition_by_shard": "SELECT source AS shard_id, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY source",
        "text_normalize": f"WITH {BASE} SELECT doc_id, norm FROM docs",
        "norm_words": f"WITH {BASE} SELECT doc_id, CAST(len(nw) AS BIGINT) AS n, array_to_string(nw, '|') AS words FROM docs",
        "raw_words": f"WITH {BASE} SELECT doc_id, CAST(len(rw) AS BIGINT) AS n, array_to_string(rw, '|') AS words FROM docs",
        "explode_words": f"WITH {BASE} SELECT word, count(*) AS n FROM (SELECT unnest(nw) AS word FROM docs) GROUP BY word",
        "ngrams_2": f"WITH {BASE}, g AS ({grams('nw', 2)}) SELECT gram, count(*) AS n FROM g GROUP BY gram",
        "ngrams_3": f"WITH {BASE}, g AS ({grams('nw', 3)}) SELECT gram, count(*) AS n FROM g GROUP BY gram",
        "split_lines": f"{LINES} SELECT doc_id, line_no, end_pos - length(line) AS start_pos, end_pos, line FROM spans",
        "paragraphs_nonempty": f"{LINES} SELECT doc_id, line_no, end_pos - length(line) AS start_pos, end_pos, line FROM spans WHERE {strip('line')} <> ''",
        "classifier_text": f"SELECT doc_id, {strip(FLAT)} AS flat FROM documents",
        "text_span": f"SELECT doc_id, array_to_string(list_filter(string_split(translate(translate(text, concat('ABCDEFGHIJKLMNOPQRSTUVWXYZ', chr(10)), 'abcdefghijklmnopqrstuvwxyz '), {q(PUNCTUATION)}, ''), ' '), lambda w: w <> '')[3:22], ' ') AS span FROM documents",
        "sha1_hash32": f"SELECT doc_id, CAST({little_endian('sha1(text)', 4)} AS BIGINT) AS h FROM documents",
        "doc_id_hash": f"SELECT doc_id, CAST({little_endian('sha1(id)', 8)} AS VARCHAR) AS id_int FROM (SELECT doc_id, concat(source, '/', doc_id) AS id FROM documents)",
        "category_index": f"WITH RECURSIVE {CATEGORY_SETS} SELECT category_id, categories FROM idx",
        "rps_doc_ut1_blacklist": f"""WITH RECURSIVE {CATEGORY_SETS}, pairs(domain, category) AS ({DOMAINS}),
  sets AS (SELECT domain, string_agg(DISTINCT category, ',' ORDER BY category) AS categories FROM pairs GROUP BY domain)
SELECT page_id, {HOST} AS domain, CAST(i.category_id AS DOUBLE) AS score FROM pages p LEFT JOIN sets s ON s.domain = {HOST} LEFT JOIN idx i ON i.categories = s.categories""",
        "domain_categories": f"""WITH pairs(domain, category) AS ({DOMAINS})
SELECT domain, string_agg(DISTINCT category, ',' ORDER BY category) AS categories FROM pairs GROUP BY domain""",
        "sig_passthrough": f"WITH {BASE} SELECT doc_id, CAST(n_chars AS DOUBLE) AS ccnet_length, CAST(len(ln) AS DOUBLE) AS ccnet_nlines FROM docs",
        "rps_doc_ldnoobw_words": doc(bad_words()),
        "badword_semi_join": f"""WITH {BASE}, g1 AS ({grams("nw", 1)}), g2 AS ({grams("nw", 2)}), grams AS (SELECT doc_id, gram FROM g1 UNION ALL SELECT doc_id, gram FROM g2),
  list(lang, phrase) AS (VALUES {", ".join(f"({q(k)}, {q(p)})" for k, v in BAD_WORDS.items() for p in v)})
SELECT d.doc_id, count(g.doc_id) AS hits FROM docs d LEFT JOIN (SELECT g.doc_id FROM grams g JOIN documents x ON x.doc_id = g.doc_id SEMI JOIN list l ON l.lang = x.lang AND l.phrase = g.gram) g ON g.doc_id = d.doc_id GROUP BY d.doc_id""",
        "rps_doc_lorem_ipsum": doc(ratio("len(regexp_extract_all(norm, 'lorem ipsum'))", "length(norm)", "0.0")),
        "rps_doc_curly_bracket": doc(ratio("length(text) - length(translate(text, '{}', ''))", "length(text)", "0.0")),
        "curly_brackets_in_pages": "SELECT page_id, round((length(html) - length(translate(html, '{}', ''))) / CAST(length(html) AS DOUBLE), 8) AS score FROM pages",
        "blacklist_left_join": f"""WITH pairs(domain, category) AS ({DOMAINS}),
  sets AS (SELECT domain, string_agg(DISTINCT category, ',' ORDER BY category) AS categories FROM pairs GROUP BY domain)
SELECT page_id, {HOST} AS domain, s.categories FROM pages p LEFT JOIN sets s ON s.domain = {HOST}""",
        "rps_doc_stop_word_fraction": doc(stop_words()),
        "rps_doc_num_sentences": doc(f"len(regexp_extract_all(text, {q(SENTENCE)}))"),
        "rps_doc_word_count": doc("len(nw)"),
        "rps_doc_mean_word_length": doc(ratio("length(replace(norm, ' ', ''))", "len(nw)")),
        "rps_doc_symbol_to_word_ratio": doc(ratio("(length(text) - length(replace(text, '#', ''))) + (length(text) - length(replace(text, '...', ''))) // 3 + (length(text) - length(replace(text, '…', '')))", "len(rw)")),
        "rps_doc_frac_lines_end_with_ellipsis": doc(ratio(f"len(list_filter(ln, lambda x: regexp_matches(x, {q(ELLIPSIS_END)})))", "len(ln)")),
        "rps_doc_frac_no_alph_words": doc(ratio("len(rw) - len(list_filter(rw, lambda w: regexp_matches(w, '[a-zA-Z]')))", "len(rw)")),
        "rps_doc_frac_unique_words": doc(ratio("len(list_distinct(nw))", "len(nw)")),
        "rps_doc_unigram_entropy": f"""WITH {BASE}, c AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(nw) AS word FROM docs) GROUP BY doc_id, word),
  p AS (SELECT doc_id, n / CAST(sum(n) OVER (PARTITION BY doc_id) AS DOUBLE) AS p FROM c), e AS (SELECT doc_id, -sum(p * ln(p)) AS e FROM p GROUP BY doc_id)
SELECT d.doc_id, round(round(e.e, 8), 6) + 0.0 AS score FROM docs d LEFT JOIN e ON e.doc_id = d.doc_id""",
        "rps_doc_frac_all_caps_words": doc(ratio(r"len(list_filter(rw, lambda w: regexp_matches(w, '\p{Lu}') AND NOT regexp_matches(w, '[\p{Ll}\p{Lt}]')))", "len(rw)")),
        "rps_lines_javascript_counts": line(f"len(list_filter(string_split({plain_norm('line')}, ' '), lambda w: w = 'javascript'))"),
        "rps_lines_ending_with_terminal_punctution_mark": line(f"CAST(regexp_matches(line, '[.!?”][{SPACE}]*$') AS INTEGER)"),
        "rps_lines_num_words": line(f"len({split_words(plain_norm('line'))})"),
        "rps_lines_uppercase_letter_fraction": line(r"CASE WHEN length(line) = 0 THEN 0.0 ELSE len(regexp_extract_all(line, '\p{Lu}')) / CAST(length(line) AS DOUBLE) END"),
        "rps_lines_numerical_chars_fraction": f"{LINES}, n AS (SELECT *, {nfd(plain_norm('line'))} AS nl FROM spans) SELECT doc_id, line_no, end_pos - length(line) AS start_pos, end_pos, round(CASE WHEN nl = '' THEN 0.0 ELSE len(regexp_extract_all(nl, '\\p{{N}}')) / CAST(length(nl) AS DOUBLE) END, 8) AS score FROM n",
        "rps_lines_start_with_bulletpoint": line(f"CAST(regexp_matches(line, '^[{SPACE}]*[{BULLETS}]') AS INTEGER)"),
        "linear_score": f"""{FEATURES} SELECT doc_id, round(1 / (1 + exp(-avg(((bucket * 7919) % 2001 - 1000) / 1000.0::DOUBLE))), 6) AS score FROM feats GROUP BY doc_id""",
        "hash_features": f"{FEATURES} SELECT doc_id, bucket, count(*) AS cnt FROM feats GROUP BY doc_id, bucket",
        "dsir_counts": f"{FEATURES} SELECT bucket, count(*) AS cnt FROM feats GROUP BY bucket",
        "dsir_lambda": f"SELECT round(avg(len(regexp_extract_all(text, {q(RAW_WORD)}))), 6) AS lambda FROM documents",
        "importance_weight": f"{MODELS} SELECT f.doc_id, round(sum(lr.lr), 4) AS importance FROM feats f JOIN lr ON lr.bucket = f.bucket GROUP BY f.doc_id",
        "importance_length_correction": f"""{MODELS},
  s AS (SELECT f.doc_id, sum(lr.lr) AS importance FROM feats f JOIN lr ON lr.bucket = f.bucket GROUP BY f.doc_id),
  l AS (SELECT (SELECT avg(len(rw)) FROM raw WHERE doc_id IN (SELECT doc_id FROM good)) AS t, (SELECT avg(len(rw)) FROM raw) AS s)
SELECT d.doc_id, round(s.importance + ln(exp({lgam.format("l.t")}) + 1e-8) - ln(exp({lgam.format("l.s")}) + 1e-8), 4) AS importance FROM documents d JOIN s ON s.doc_id = d.doc_id, l""",
        "token_count": f"WITH {BASE} SELECT doc_id, CAST(len(rw) AS BIGINT) AS num_tokens FROM docs",
        "token_totals": f"WITH {BASE} SELECT lang, source, count(*) AS n_docs, CAST(sum(len(rw)) AS BIGINT) AS num_tokens FROM docs GROUP BY lang, source",
        "stratified_sample": f"""WITH b AS (SELECT doc_id, source, CASE doc_id % 3 WHEN 0 THEN 'head' WHEN 1 THEN 'middle' ELSE 'tail' END AS bucket FROM documents),
  q AS (SELECT greatest(1, 400 // count(DISTINCT source)) AS k FROM documents),
  r AS (SELECT *, row_number() OVER (PARTITION BY source, bucket ORDER BY doc_id) AS n FROM b)
SELECT doc_id, source, bucket FROM r, q WHERE n <= floor(k * CASE bucket WHEN 'head' THEN 0.1 WHEN 'middle' THEN 0.2 ELSE 0.7 END)""",
        "chunk_paragraphs": f"""{LINES}, f AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS k, count(*) OVER (PARTITION BY doc_id) AS n FROM spans WHERE {strip('line')} <> '')
SELECT doc_id, CAST(k // 3 AS INTEGER) AS chunk, string_agg(line, chr(10) ORDER BY k) AS chunk_text FROM f WHERE k // 3 < least(n // 3, 20) GROUP BY doc_id, k // 3""",
        "exact_dup": "SELECT source AS shard_id, doc_id, sha1(text) AS digest FROM documents QUALIFY row_number() OVER (PARTITION BY sha1(text) ORDER BY source DESC, doc_id) > 1",
        "dup_stats_by_source": "SELECT shard_id, count(*) AS n_duplicates FROM (SELECT source AS shard_id FROM documents QUALIFY row_number() OVER (PARTITION BY sha1(text) ORDER BY source DESC, doc_id) > 1) GROUP BY shard_id",
        "minhash_min_k": f"{minhash(128)} SELECT doc_id, CAST(j AS INTEGER) AS perm, v AS min_hash FROM sig",
        "minhash_bands_all": f"""{minhash(128)}, sizes(threshold, bands, rows) AS (VALUES {", ".join(f"({t}::DOUBLE, {b}, {r})" for t, (b, r) in BANDS.items())})
SELECT doc_id, threshold, CAST(j // rows AS INTEGER) AS band, string_agg(printf('%08X', v), '' ORDER BY j) AS key FROM sig, sizes WHERE j < bands * rows GROUP BY doc_id, threshold, j // rows""",
        "lsh_parameters": f"""WITH thresholds(threshold) AS (VALUES {", ".join(f"({t}::DOUBLE)" for t in BANDS)}),
  shapes AS (SELECT b, r FROM (SELECT unnest(range(1, 129)) AS b), (SELECT unnest(range(1, 129)) AS r) WHERE b * r <= 128),
  steps AS (SELECT (i + 0.5) / 4000 AS x FROM (SELECT unnest(range(0, 4000)) AS i)),
  areas AS (SELECT threshold, b, r, avg(CASE WHEN x < threshold THEN 1 - pow(1 - pow(x, r), b) ELSE pow(1 - pow(x, r), b) END) AS error FROM thresholds, shapes, steps GROUP BY ALL)
SELECT threshold, CAST(b AS INTEGER) AS bands, CAST(r AS INTEGER) AS rows FROM areas QUALIFY row_number() OVER (PARTITION BY threshold ORDER BY error, b, r) = 1""",
        "seeded_shuffle": "SELECT doc_id, md5(concat('42/', doc_id)) AS shuffle_key FROM documents",
        "minhash_bands": f"{banded(0.7)} SELECT doc_id, band, key FROM bands",
        "lsh_edges": f"{edges(0.7)} SELECT src, dst FROM edges",
        "connected_components": f"{cluster(0.7)} SELECT node, cluster_id FROM comp",
        "dup_clusters": f"{cluster(0.7)} SELECT d.doc_id, c.cluster_id, d.source AS shard_id FROM documents d JOIN comp c ON c.node = d.doc_id",
        "topk_clusters": f"{cluster(0.7)} SELECT cluster_id, doc_id FROM (SELECT c.cluster_id, d.doc_id FROM documents d JOIN comp c ON c.node = d.doc_id) ORDER BY cluster_id, doc_id LIMIT 20",
    }
    for n in (2, 3, 4):
        sql[f"rps_doc_frac_chars_top_{n}gram"] = top_gram(n)
    for n in range(5, 11):
        sql[f"rps_doc_frac_chars_dupe_{n}grams"] = dupe_gram(n)
    lines = [n for n in sql if n.startswith("rps_lines_")]
    whole = [n for n in sql if n.startswith("rps_doc_") and n != "rps_doc_ut1_blacklist"]
    score = "round(s.score, 6) + 0.0 AS score"
    parts = [f"SELECT s.doc_id, {q(n)} AS signal, CAST(0 AS BIGINT) AS start_pos, CAST(length(d.text) AS BIGINT) AS end_pos, {score} FROM ({sql[n]}) s JOIN documents d ON d.doc_id = s.doc_id" for n in whole]
    parts += [f"SELECT doc_id, {q(n)} AS signal, CAST(start_pos AS BIGINT) AS start_pos, end_pos, {score} FROM ({sql[n]}) s" for n in lines]
    bullet = q("rps_lines_start_with_bulletpoint")
    parts.append(f"SELECT doc_id, {bullet} AS signal, CAST(0 AS BIGINT) AS start_pos, CAST(0 AS BIGINT) AS end_pos, CAST(NULL AS DOUBLE) AS score FROM documents WHERE text = ''")
    sql["quality_signals_long"] = " UNION ALL ".join(parts)
    return sql
