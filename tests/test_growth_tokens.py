from __future__ import annotations

import random

import pyarrow as pa
import pytest

from textquarry.operators import sampling
from textquarry.queries import TOKENIZER


def test_tokens_of_pieces():
    """Distinct pieces are encoded once; the sums are those of whole texts, whatever signs and white space they hold."""
    tokenizers = pytest.importorskip("tokenizers")
    content = open(TOKENIZER, encoding="utf-8").read()
    tokenizer, draw = tokenizers.Tokenizer.from_str(content), random.Random(8)
    signs = [" ", " ", "  ", "\n", "\t", "\x1c", "\x85", "\u00a0", "\u2028", "\u3000", "a", "bc", "\u00e9", "\u00df", "'s", "'", "12", "\u6f22", "<|endoftext|>", "<|end", "...", "\u200b", "\ufeff"]
    texts = ["", None] + ["".join(draw.choice(signs) for _ in range(draw.randint(0, 14))) for _ in range(3000)]
    assert sampling._by_pieces(content)
    known = {}
    want = [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts])]
    assert sampling._piece_counts(pa.array(texts), tokenizer, known).tolist() == want
    assert sampling._piece_counts(pa.array(texts), tokenizer, known).tolist() == want and known


def test_other_tokenizers_read_whole_texts():
    content = open(TOKENIZER, encoding="utf-8").read()
    assert not sampling._by_pieces(content.replace('"add_prefix_space":false', '"add_prefix_space":true', 1))
    assert not sampling._by_pieces(content.replace('"normalizer":null', '"normalizer":{"type":"NFC"}', 1))
    assert not sampling._by_pieces(content.replace('"rstrip":false', '"rstrip":true', 1))
