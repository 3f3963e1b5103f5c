"""Standing queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textquarry.llm import bpe, chat, decontam, exact_dedup, html, langid, near_dedup, secrets, sharding, substrings
from textquarry.llm.words import GAP_PATTERN


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(_table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_repeats(_table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(_table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(_table(spark, sf_dir, "conversations"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.cut_repeats(_table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(_table(spark, sf_dir, "documents"))


def queries() -> dict:
    found = (
        op1_language_id,
        op2_sharding,
        op3_byte_bpe,
        op4_exact_dedup,
        op5_html_extraction,
        op6_decontamination,
        op7_near_dedup,
        op8_chat_formatting,
        op9_substring_dedup,
        op10_secret_scan,
    )
    return {f.__name__: f for f in found}


OLD_SOURCES = """
  names AS (SELECT source, row_number() OVER (ORDER BY source) AS k, count(*) OVER () AS n
            FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL) AS d),
  halves AS (SELECT d.doc_id, d.text, coalesce(n.k <= n.n // 2, false) AS old
             FROM documents AS d LEFT JOIN names AS n ON d.source = n.source WHERE d.text IS NOT NULL)"""

_FOLDED = f"concat(' ', trim(regexp_replace(lower(text), '{GAP_PATTERN}', ' ', 'g')), ' ')"


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_dedup": f"""
WITH {OLD_SOURCES},
  ranked AS (
    SELECT doc_id, row_number() OVER w AS r, first_value(doc_id) OVER w AS duplicate_of,
           CASE WHEN NOT old AND NOT first_value(old) OVER w THEN 'group' ELSE 'history' END AS found_in
    FROM halves WINDOW w AS (PARTITION BY text ORDER BY old DESC, doc_id NULLS LAST))
SELECT doc_id, duplicate_of, found_in FROM ranked WHERE r > 1""",
        "op6_decontamination": f"""
WITH items AS (SELECT item_id, string_split(trim({_FOLDED}), ' ') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
  starts AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - {decontam.NGRAM} + 1, 1) + 1)) AS k
             FROM items WHERE len(w) >= {decontam.LINE_WORDS}),
  strings AS (SELECT DISTINCT item_id, concat(' ', array_to_string(w[k:k + {decontam.NGRAM} - 1], ' '), ' ') AS s FROM starts),
  texts AS (SELECT doc_id, row_number() OVER () AS r, {_FOLDED} AS t, text FROM documents WHERE text IS NOT NULL),
  whole AS (SELECT item_id, array_to_string(w, ' ') AS s FROM items WHERE len(w) < {decontam.LINE_WORDS} AND w[1] <> ''),
  lines AS (SELECT DISTINCT doc_id, r, trim({_FOLDED}) AS s FROM (SELECT doc_id, r, unnest(string_split(text, chr(10))) AS text FROM texts))
SELECT doc_id, item_id, count(*) AS windows FROM texts JOIN strings ON contains(t, s) GROUP BY doc_id, r, item_id
UNION ALL SELECT doc_id, item_id, 1 AS windows FROM lines JOIN whole ON lines.s = whole.s""",
    }
