"""Secret scan by dictionary-primed zstandard novelty.

A candidate is a token-like string in the window around a sensitive word: a quoted string, or a run without white space
and without the signs that split expressions, which may hold signs and need not follow the word at once. How new it is, is measured in
compressed bytes: zstandard, primed with a dictionary of identifiers that all documents use and of words of the whole
text, compresses the surrounding text once without and once with the candidate. Identifiers, words and repeated values cost
next to nothing; a random key, in which nothing matches, costs what any random string of its length and alphabet does:
about a byte for each character of a short one, its entropy where zstandard codes literals. Candidates whose cost is at
least the share ``least`` of what the cheapest of such strings costs in their place are reported.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from random import Random
from string import ascii_letters, ascii_lowercase, ascii_uppercase, digits, hexdigits

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.plans.runtime import small_batches, spread, write_shared

CONTEXT = 80
#: Bytes of a text's own words that its candidates are measured with; of more, those that it uses most.
VOCABULARY_BYTES = 1 << 15
#: Bytes of the identifiers and words that the corpus uses most, half of them for each.
CORPUS_BYTES = 1 << 15
#: Distinct words that one task counts before it hands its counts on.
COUNTED_WORDS = 1 << 18
#: A candidate starts or ends at most so many characters from a sensitive word.
WINDOW = 80
MIN_LENGTH = 6
#: From this length on any string of token characters may be a key; shorter ones have to look like one, see ``_plausible``.
LONG = 16
#: Marginal compressed bytes for each byte that random strings cost: random keys lie about 1, identifiers below 0.65.
MIN_NOVELTY = 0.75
#: Random strings that a candidate is compared with, and the length from which their cost is taken from a shorter one's.
DRAWS = 5
MAX_DRAWN = 1 << 14
#: A string of LITERALS bytes or more (from there on zstandard codes literals) shows a small alphabet by itself.
LITERALS, SMALL_ALPHABET = 64, 16
#: Alphabets of random keys; the smallest that holds all of another string is its own.
ALPHABETS = [bytes(x, "ascii") for x in (digits, hexdigits[:16], digits + "ABCDEF", ascii_lowercase, ascii_uppercase, digits + ascii_lowercase, digits + ascii_uppercase, ascii_letters, ascii_letters + digits, ascii_letters + digits + "+/=_-.~")]

#: Sensitive words, also as parts of longer identifiers. Python and the JVM read the pattern alike.
WORDS = (
    r"(?i:client[_-]?secret|pass(?:word|wd|phrase|code|key)|passwort|pwd|secret|token|(?:api|access|private|auth|signing|encryption)[_-]?key|authorization|bearer|credentials?|signature)"
    r"|(?i:pass|auth)(?![a-z])"
)
SENSITIVE = re.compile(WORDS, re.ASCII)
#: Quoted strings without white space, else runs without white space and quotes.
_RUN = re.compile(r""""((?:[^"\\\s]|\\\S)*)"|'((?:[^'\\\s]|\\\S)*)'|`([^`\s]*)`|([^\s"'`]+)""")
_PIECE = re.compile(r"""[^()\[\]{}<>,;&?|\s"'`]+""")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=.~\-]+")
_WORD = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z_]{3,}(?![A-Za-z0-9_])")
_NAME = re.compile(r"[A-Za-z_$@-][\w.$-]*(?:=>|:=|={1,3}|:)(?!//|[=:]|$)")
_SIGNS = re.compile(r"[^\w\s._/:@,-]")
#: Times and mail addresses: novel, but no secrets where a sensitive word only stands near.
_PLAIN = re.compile(r"\d{4}-\d\d-\d\dT[\d:.]+(?:Z|[+-][\d:]+)?|[\w.+-]+@[\w-]+(?:\.[\w-]+)+")
#: What may stand between a sensitive word and its own value: the rest of the identifier, a separator or call, a scheme, a prefix.
_DIRECT = re.compile(r"""\w*["'`\])]*\s*(=>|:=|[=:(]+|(?=\s))\s*(?:(?i:basic|bearer|digest|token)\s+)?[rbuf@$]{0,2}["'`]?""")
#: The same within one line, with whatever leads to a quoted value.
_SAME_LINE = re.compile(r"""\w*["'`\])]*\s*[=:(][^\n;]*""")

#: Words and identifiers that source code and settings are full of; the dictionary every candidate is measured with.
IDENTIFIERS = (
    "null none true false undefined return import from class def function const let var static public private "
    "config settings options default example sample changeme placeholder your_api_key_here insert_token_here "
    + " ".join(c * 16 for c in "x.-_0") + " 1234567890123456 "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef "
    "process.env.SECRET_KEY os.environ.get getenv request.headers authorization_code access_token refresh_token "
    "client_id client_secret api_key password_hash token_type expires_in username localhost application/json "
    "content-type text/html utf-8 http:// https:// www. .com .org /usr/local/bin /etc/config src/main/java "
    "user_name first_name last_name email_address phone_number created_at updated_at response_status "
    "get_password set_password validate_token generate_token token_validator SecretManager PasswordEncoder "
)

FOUND = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("novel_bytes", T.IntegerType()), T.StructField("novelty", T.DoubleType()), T.StructField("keyword", T.StringType())]))


def random_like(value: bytes) -> list[bytes]:
    """Random strings of the length and alphabet of ``value``, always the same ones; with its other bytes where no alphabet has them all."""
    alphabet = next((x for x in ALPHABETS if not value.translate(None, x)), bytes(sorted({*ALPHABETS[-1], *value})))
    if len(value) >= LITERALS and 1 < len(own := bytes(sorted({*value}))) <= SMALL_ALPHABET:
        alphabet = own
    size = min(len(value), MAX_DRAWN)
    draw = Random(len(value) * 256 + len(alphabet))
    return [bytes(draw.choices(alphabet, k=size)) for _ in range(DRAWS)]


class Novelty:
    """Marginal compressed size of a string against its surroundings and the identifier dictionary."""

    def __init__(self, level: int = 9, corpus: list[str] | None = None):
        self.level = level
        self.corpus = corpus or []
        self._joined = " ".join(self.corpus)

    def _dictionary(self, value: str) -> bytes:
        """Identifiers of the corpus, none of which holds the value itself, and the constant ones."""
        own = self._joined if value not in self._joined else " ".join(w for w in self.corpus if value not in w)
        return (own + "\n" + IDENTIFIERS).encode()

    def cost(self, before: bytes, value: bytes, after: bytes, known: bytes = b"") -> tuple[int, float]:
        """Bytes that ``value`` adds, the whole less the surroundings alone, and those that the cheapest of random strings like it adds.

        A copy of the value nearby doesn't make it known. ``known`` are other words of the text.
        """
        before, after = before.replace(value, b""), after.replace(value, b"")
        dictionary = self._dictionary(value.decode()) + known + b"\n" + before + b"\n" + after
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(self.level)
        compressor = zstandard.ZstdCompressor(level=self.level, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)
        size = lambda data: len(compressor.compress(data))
        alone = size(before[-16:] + after[:16])

        def added(x: bytes) -> int:
            return size(before[-16:] + x + after[:16]) - alone

        drawn = random_like(value)
        return added(value), min(map(added, drawn)) * len(value) / len(drawn[0])  # some are coded, some stay plain


class Vocabulary:
    """Words and identifiers of a whole text; runs with digits are none, as they may belong to keys."""

    def __init__(self, text: str):
        self.text, self.counts = text, Counter(_WORD.findall(text))
        size, self.words = 0, []
        for w, _ in self.counts.most_common():
            size += len(w) + 1
            if size > VOCABULARY_BYTES:
                break
            self.words.append(w)
        self.joined = " ".join(self.words).encode()

    def without(self, value: str) -> bytes:
        """The words that the text holds outside of the copies of ``value`` too, most used ones last."""
        own = Counter(_WORD.findall(value))
        copies = self.text.count(value) if own else 0
        gone = {w for w, k in own.items() if self.counts[w] <= k * copies}
        # words that reach over an end of the value, such as the name that it is given to
        gone |= {w for w in self.words if value in w}
        return " ".join(w for w in self.words if w not in gone).encode() if gone else self.joined


def _regions(text: str, words: list[re.Match]) -> list[list[int]]:
    """The windows around the sensitive words, widened to whole runs and merged."""
    out: list[list[int]] = []
    for m in words:
        a, b, done = max(0, m.start() - WINDOW), min(len(text), m.end() + WINDOW), out[-1][1] if out else 0
        while a > done and not text[a - 1].isspace():
            a -= 1
        if b > done:
            while b < len(text) and not text[b].isspace():
                b += 1
        if out and a <= done:
            out[-1][1] = max(done, b)
        else:
            out.append([a, b])
    return out


def _classes(value: str) -> tuple[bool, bool, bool, bool]:
    """Whether a string holds lower case, upper case, digits, and signs that no identifier, path or address has."""
    return *(any(map(kind, value)) for kind in (str.islower, str.isupper, str.isdigit)), bool(_SIGNS.search(value))


def _plausible(value: str, gap: str | None, quoted: bool) -> bool:
    """Whether a string is token-like. ``gap`` is the text between a sensitive word and the string, None if the word follows.

    The value of the word itself may be any quoted literal; elsewhere words and numbers of prose are no candidates.
    """
    if len(value) < MIN_LENGTH:
        return False
    lower, upper, digit, sign = _classes(value)
    letter, classes = any(map(str.isalpha, value)), lower + upper + digit + sign
    direct = _DIRECT.fullmatch(gap) if gap is not None else None
    if direct and (len(value) >= LONG or (direct.group(1) and (quoted or classes >= 2 and (digit or sign)))):
        return True
    if quoted and classes >= 2 and gap is not None and _SAME_LINE.fullmatch(gap):
        return True
    return digit and letter and (len(value) >= LONG or len(value) >= 8 and classes >= 3) and not _PLAIN.fullmatch(value)


def scan(text: str | None, novelty: Novelty, least: float = MIN_NOVELTY) -> list[dict]:
    """Reported strings of one text, by position (character offsets)."""
    out: list[dict] = []
    words = list(SENSITIVE.finditer(text)) if text else []
    vocabulary = Vocabulary(text) if words else None
    starts, ends = [m.start() for m in words], [m.end() for m in words]

    def report(a: int, b: int, quoted: bool) -> bool:
        """Report text[a:b] if it is token-like and novel."""
        k = bisect_right(ends, a) - 1
        before = k >= 0 and a - ends[k] <= WINDOW
        if not before:
            k = bisect_left(starts, b)
            if k == len(words) or starts[k] - b > WINDOW:
                return False
        value = text[a:b]
        if not _plausible(value, text[ends[k] : a] if before else None, quoted):
            return False
        raw = value.encode()
        # without copies of the value first: the edge of the context would leave a part of one
        ahead = text[max(0, a - CONTEXT - len(value)) : a].replace(value, "")[-CONTEXT:]
        behind = text[b : b + CONTEXT + len(value)].replace(value, "")[:CONTEXT]
        cost, usual = novelty.cost(ahead.encode(), raw, behind.encode(), vocabulary.without(value))
        share = cost / max(usual, 1.0)
        if share < least:
            return False
        out.append({"start": a, "end": b, "novel_bytes": cost, "novelty": round(share, 4), "keyword": words[k].group().lower()})
        return True

    def trimmed(a: int, b: int) -> tuple[int, int]:
        """Without punctuation around it and the name that it is given to."""
        b = a + len(text[a:b].rstrip(".,:;!?-~"))
        name = _NAME.match(text, a, b)
        return (name.end() if name else a), b

    for left, right in _regions(text, words) if words else ():
        for run in _RUN.finditer(text, left, right):
            quoted = run.lastindex < 4
            a, b = run.span(run.lastindex)
            if quoted and report(a, b, True):
                continue
            found = False
            for piece in _PIECE.finditer(text, a, b):
                x, y = trimmed(*piece.span())
                if report(x, y, quoted and x == a):
                    found = True
                    continue
                for part in _TOKEN.finditer(text, x, y):
                    found |= part.span() != (x, y) and report(*part.span(), False)
            if not (quoted or found):  # signs that split expressions may belong to a value
                x, y = trimmed(a, b)
                if not _PIECE.fullmatch(text, x, y) and text[y - 1 : y] not in ")]}>" and sum(_classes(text[x:y])) >= 3:
                    report(x, y, False)
    return out


_JOINED_WORD = re.compile(r"_|[a-z][A-Z]")


def corpus_identifiers(docs: DataFrame, size: int = CORPUS_BYTES) -> list[str]:
    """The identifiers and words that all texts use most, ``size`` bytes of them, the most used ones last.

    Half of the bytes are for identifiers joined of several words. Ties go to the first by code points.
    """

    def count(batches):
        held: Counter = Counter()

        def counts() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                held.update(_WORD.findall(text.as_py() or ""))
                if len(held) > COUNTED_WORDS:
                    yield counts()
                    held.clear()
        yield counts()

    words = write_shared(spread(docs.select("text")).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1 AND length(word) <= 64"), "identifiers")
    found = []
    for joined in (False, True):
        some = words.where(F.col("word").rlike(_JOINED_WORD.pattern) == joined).orderBy(F.desc("n"), "word").limit(size // 8).collect()  # three letters and a space at least: size / 2 bytes
        room = size // 2
        for r in some:
            room -= len(r["word"]) + 1
            if room < 0:
                break
            found.append((r["n"], r["word"]))
    return [w for _, w in sorted(found, key=lambda x: (x[0], x[1]))]


def secret_spans(docs: DataFrame, column: str = "_secrets", least: float = MIN_NOVELTY, identifiers: list[str] | None = None) -> DataFrame:
    """Rows that may hold a secret, with the reported strings of each as an array in ``column``.

    Texts without a sensitive word never leave the JVM and are not returned. ``identifiers`` are those of the corpus,
    counted over ``docs`` where none are given.
    """

    small_batches(docs.sparkSession)
    known = corpus_identifiers(docs) if identifiers is None else identifiers

    @F.arrow_udf(FOUND)
    def found(text: pa.Array) -> pa.Array:
        novelty = Novelty(corpus=known)
        rows = [scan(t.as_py(), novelty, least) for t in text]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("novel_bytes", pa.int32()), ("novelty", pa.float64()), ("keyword", pa.string())]))
        return pa.array(rows, kind)

    return spread(docs).where(F.col("text").rlike(WORDS)).withColumn(column, found("text"))


def secrets(docs: DataFrame, least: float = MIN_NOVELTY, identifiers: list[str] | None = None) -> DataFrame:
    """doc_id, start, end, novel_bytes, novelty, keyword of every reported string; the string itself is not shown.

    Offsets count characters. A string that a text repeats is reported at each place. Null and empty texts hold
    nothing; very long texts are scanned whole; repeated rows report each their own. A null doc_id stays null. Ties play
    no part. An empty table gives no rows; columns but doc_id and text play no part, whatever their names.
    """
    rows = secret_spans(docs.select("doc_id", "text"), "_secrets", least, identifiers)
    # the outer form keeps Spark from scanning once more to filter by size
    return rows.select("doc_id", F.explode_outer("_secrets").alias("s")).where("s IS NOT NULL").select("doc_id", "s.*")
