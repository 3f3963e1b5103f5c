"""Quality signals of documents: a registry of column builders and the annotated record they make together.

Document signals are numbers; line signals are arrays of (start, end, score). Every builder takes the derived columns
of ``prepared`` by name, so that normalising and tokenising happen once a row: words and lines are measured in one pass
each (``measures``), repetitions in another, the rest are built-in expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions import text as X
from textquarry.functions.lexicons import BAD_WORDS, STOP_WORDS
from textquarry.operators.measures import line_measures, word_measures
from textquarry.operators.repetition import DUPE, TOP, repetitions
from textquarry.plans.runtime import small_batches

SPAN = "array<struct<start:int,end:int,score:double>>"
DOC_SIGNALS: dict[str, Callable[[], Column]] = {}
LINE_SIGNALS: dict[str, Callable[[], Column]] = {}


def doc_signal(name: str):
    """Register a document signal; user code may add its own."""

    def add(build: Callable[[], Column]):
        DOC_SIGNALS[name] = build
        return build

    return add


def line_signal(name: str):
    """Register a signal computed for every line."""

    def add(build: Callable[[Column], Column]):
        LINE_SIGNALS[name] = build
        return build

    return add


def prepared(docs: DataFrame, text: str = "text", lang: str = "lang", stop_words: dict[str, list[str]] | None = None, bad_words: dict[str, list[str]] | None = None) -> DataFrame:
    """Add the derived columns _text, _lang, _norm, _words, _raw, _lines, _rep, _w (word measures) and _l (line measures).

    The lists are by language and default to the small ones of ``lexicons``. A column that no signal takes costs nothing.
    """
    small_batches(docs.sparkSession)
    base = docs.withColumns({"_text": F.coalesce(F.col(text), F.lit("")), "_lang": F.col(lang)})
    plain = base.withColumns({"_norm": X.normalize(F.col("_text")), "_raw": X.raw_words(F.col("_text")), "_lines": X.line_spans(F.col("_text")), "_l": line_measures(F.col("_text"))})
    words = word_measures(F.col("_text"), F.col("_norm"), F.col("_lang"), STOP_WORDS if stop_words is None else stop_words, BAD_WORDS if bad_words is None else bad_words)
    return plain.withColumns({"_words": X.norm_words(F.col("_norm")), "_rep": repetitions(F.col("_norm")), "_w": words})


def _n_words() -> Column:
    return F.col("_w.words")


def _n_raw() -> Column:
    return F.col("_w.raw")


def _share(part: Column, whole: Column, none: float | None = None) -> Column:
    return X.score(F.when(whole > 0, part / whole).otherwise(F.lit(none).cast("double")))


@doc_signal("rps_doc_ldnoobw_words")
def _bad_words() -> Column:
    return X.score(F.col("_w.bad"))


@doc_signal("rps_doc_lorem_ipsum")
def _lorem() -> Column:
    return _share(F.regexp_count("_norm", F.lit("lorem ipsum")), F.length("_norm"), 0.0)


@doc_signal("rps_doc_curly_bracket")
def _curly() -> Column:
    return _share(F.length("_text") - F.length(F.translate("_text", "{}", "")), F.length("_text"), 0.0)


@doc_signal("rps_doc_stop_word_fraction")
def _stop_words() -> Column:
    return F.when(_n_words() == 0, F.lit(0.0)).otherwise(X.score(F.col("_w.stop") / _n_raw()))


@doc_signal("rps_doc_num_sentences")
def _sentences() -> Column:
    return X.score(F.regexp_count("_text", F.lit(X.SENTENCE)))


@doc_signal("rps_doc_word_count")
def _word_count() -> Column:
    return X.score(_n_words())


@doc_signal("rps_doc_mean_word_length")
def _mean_length() -> Column:
    letters = F.length(F.replace(F.col("_norm"), F.lit(" "), F.lit("")))
    return _share(letters, _n_words())


@doc_signal("rps_doc_symbol_to_word_ratio")
def _symbols() -> Column:
    return _share(sum((X.occurrences(F.col("_text"), s) for s in ("#", "...", "…")), F.lit(0)), _n_raw())


@doc_signal("rps_doc_frac_lines_end_with_ellipsis")
def _ellipsis() -> Column:
    return _share(F.col("_l.ellipsis"), F.col("_l.n"))


@doc_signal("rps_doc_frac_no_alph_words")
def _no_letters() -> Column:
    return _share(F.col("_w.no_letter"), _n_raw())


@doc_signal("rps_doc_frac_unique_words")
def _unique() -> Column:
    return _share(F.col("_w.unique"), _n_words())


@doc_signal("rps_doc_unigram_entropy")
def _entropy() -> Column:
    return X.score(F.col("_rep.entropy"))


@doc_signal("rps_doc_frac_all_caps_words")
def _caps() -> Column:
    return _share(F.col("_w.caps"), _n_raw())


for _n in TOP:
    DOC_SIGNALS[f"rps_doc_frac_chars_top_{_n}gram"] = lambda n=_n: X.score(F.col(f"_rep.top_{n}gram"))
for _n in DUPE:
    DOC_SIGNALS[f"rps_doc_frac_chars_dupe_{_n}grams"] = lambda n=_n: X.score(F.col(f"_rep.dupe_{n}grams"))


#: Line signals that one pass measures together.
MEASURED = {
    "rps_lines_javascript_counts": "javascript",
    "rps_lines_ending_with_terminal_punctution_mark": "terminal",
    "rps_lines_num_words": "words",
    "rps_lines_uppercase_letter_fraction": "uppercase",
    "rps_lines_numerical_chars_fraction": "numeric",
    "rps_lines_start_with_bulletpoint": "bullet",
}


def line_names() -> list[str]:
    return [*MEASURED, *LINE_SIGNALS]


def line_scores(name: str) -> Column:
    """array<struct<start,end,score>> of a line signal; those of callers see each line's text."""
    if name in MEASURED and name not in LINE_SIGNALS:
        return F.col(f"_l.{MEASURED[name]}")
    build = LINE_SIGNALS[name]
    return F.transform("_lines", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), X.score(build(x["text"])).alias("score")))


def all_line_scores(docs: DataFrame) -> DataFrame:
    """Add every line signal as a column. Empty texts have no lines; the bullet signal then spans nothing with a null."""
    whole = F.array(F.struct(F.lit(0).alias("start"), F.length("_text").alias("end"), F.lit(None).cast("double").alias("score")))
    found = {name: line_scores(name) for name in line_names()}
    bullet = "rps_lines_start_with_bulletpoint"
    return docs.withColumns(found | {bullet: F.when(F.col("_l.n") == 0, whole).otherwise(found[bullet])})


#: Numbers that come with the corpus and pass through as signals.
PASSTHROUGH = ("ccnet_length", "ccnet_original_length", "ccnet_nlines", "ccnet_original_nlines", "ccnet_language_score", "ccnet_perplexity")


def passthrough(docs: DataFrame, columns: dict[str, str], bucket: str | None = None) -> dict[str, Column]:
    """Corpus signals from the given columns; those that the corpus doesn't have are null."""
    out = {name: F.col(columns[name]).cast("double") if name in columns else F.lit(None).cast("double") for name in PASSTHROUGH}
    return out | {"ccnet_bucket": X.bucket_code(F.col(bucket)) if bucket else F.lit(None).cast("double")}


def annotate(docs: DataFrame, id_column: str, shard: str, text: str = "text", lang: str = "lang", signals: dict[str, Column] | None = None, corpus: dict[str, Column] | None = None, stop_words: dict[str, list[str]] | None = None, bad_words: dict[str, list[str]] | None = None, keep: dict[str, Column] | None = None) -> DataFrame:
    """id, id_int, metadata and the struct of all quality signals, each an array of (start, end, score).

    ``signals`` adds ready columns of document signals, such as classifier and importance scores; ``corpus`` the
    pass-through numbers; the lists are the caller's stop words and blocked phrases by language. ``keep`` adds columns to
    the record. A null text counts as empty.
    """
    rows = all_line_scores(prepared(docs, text, lang, stop_words, bad_words))
    whole = lambda c: F.array(F.struct(F.lit(0).alias("start"), F.length("_text").alias("end"), c.cast("double").alias("score")))
    fields = {name: whole(build()) for name, build in DOC_SIGNALS.items()}
    fields |= {name: whole(c) for name, c in {**(signals or {}), **(corpus or {})}.items()}
    fields |= {name: F.col(name).cast(SPAN) for name in line_names()}
    doc_id = F.concat_ws("/", F.col(shard), F.col(id_column).cast("string"))
    meta = F.struct(F.col(shard).alias("shard_id"), F.col("_lang").alias("language"), F.sha1("_text").alias("digest"))
    return rows.select(doc_id.alias("id"), X.doc_id_hash(doc_id).alias("id_int"), meta.alias("metadata"), F.struct(*[c.alias(k) for k, c in sorted(fields.items())]).alias("quality_signals"), *[c.alias(k) for k, c in (keep or {}).items()])
