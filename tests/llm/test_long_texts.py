"""Texts that strain the tokenizers: very long white space, and more words than a worker remembers."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from tokenizers import Tokenizer

from pressmonth.llm import bpe, packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("text", [
    " " * 60_000, "a" + " " * 60_000 + "b", "a\n" + "\t " * 40_000 + "\n b", " " * 70_000 + "." + "\n" * 70_000 + "x" + " " * 55_000,
    "\x1c" * 60_000 + " " * 60_000 + "\x1f", "é " * 40_000 + " " * 50_000 + "é", "word" + " " * 50_000 + " word",
])
def test_long_blanks_are_one_match(text):
    coder = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    pieces = [m.group() for m in regex.finditer(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"), text)]
    expected = [i for piece in pieces for i in coder._encode_single_piece(piece)]
    assert bpe.encode(coder, text) == expected
    assert coder.decode_bytes(expected) == text.encode()


@pytest.mark.parametrize("blank", [" ", "\n"])
def test_two_million_blanks(blank):
    coder = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    for text, split in ((blank * 2_000_000, 2_000_000), ("x" + blank * 2_000_000 + "y", 2_000_000)):
        ids = bpe.encode(coder, text)
        cut = [text] if text[0] == blank else ["x", blank * (split - 1), *([" y"] if blank == " " else [blank, "y"])]
        assert ids == [i for piece in cut for i in coder._encode_single_piece(piece)]


def test_forgotten_words_get_the_same_ids(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 40)
    rng = random.Random(3)
    coder, chunks = Tokenizer.from_file(WORDS), packing.ChunkTokens(WORDS)
    coder.encode_special_tokens = True
    for _ in range(60):
        texts = [" ".join(rng.choice(["the", "of", f"w{rng.randrange(90)}", "Été!", "it's", "x.y"]) for _ in range(12)) for _ in range(3)]
        ids, sizes, _ = chunks.stream(pa.array(texts))
        expected = [coder.encode(t, add_special_tokens=False).ids + [1] for t in texts]
        assert ids.tolist() == [i for e in expected for i in e] and sizes.tolist() == [len(e) for e in expected]
        assert len(chunks.word) <= 20 + 80 and np.diff(chunks.first).min(initial=1) > 0
