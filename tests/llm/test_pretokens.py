"""The array form of the byte-level split and merge against the tokenizers library."""

import random

import numpy as np
import pyarrow as pa
import pytest

from cinegraph.llm import pretokens
from cinegraph.llm.bpe import load, whole_tokens
from cinegraph.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    return load(tokenizer_path())


def made(rng, n):
    bits = ["a", "Word", "naïve", "Straße", "ñ", "Ă", "ȿ", "9", "2024", "'", "'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "''", " ", " ",
            " ", "  ", "\n", "\t", "\r\n", ".", ",", "!?", "-", "(", "\"", "it's", "don't", "'S", " 's", "\n's", "x'", "the", "ing"]
    odd = ["×", "÷", "漢字", "🙂", " ", "²", "\x0b", "\x00", "ɏɐ", "<|endoftext|>", "<|endof"]
    return "".join(rng.choice(odd if rng.random() < 0.01 else bits) for _ in range(rng.randint(0, n)))


@pytest.mark.parametrize("most", [1_000_000, 50])
def test_equals_the_library(library, most):
    rng = random.Random(most)
    texts = [made(rng, 60) for _ in range(1500)] + [None, "", " ", "  ", "\n", " a ", "a  b \n c", "q" * 300, "ab" * 40, "é" * 9,
                                                    "1234567890123456 12345678901234567", " " * 40, "'", "'s", "s's's'"]
    tokens = pretokens.PreTokens(tokenizer_path(), most)
    for _ in range(2):                                        # again, with what is known by then
        got = []
        for lo, hi, n, ids in tokens.batches(pa.array(texts)):
            ends = np.append(0, np.cumsum(n))
            assert len(n) == hi - lo and ends[-1] == len(ids)
            got += [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]
        for text, ids in zip(texts, got, strict=True):
            assert ids == library.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_slices_very_long_texts_and_offsets(library, monkeypatch):
    monkeypatch.setattr(pretokens, "_SLICE", 500)
    rng = random.Random(4)
    texts = [made(rng, 40) for _ in range(50)] + [" ".join(made(rng, 9) for _ in range(800)), "x" * 5000, "a b " * 900]
    tokens = pretokens.PreTokens(tokenizer_path(), 1000)
    column = pa.array(["skipped"] * 3 + texts).slice(3)
    got = [n for _, _, counts, _ in tokens.batches(column) for n in counts.tolist()]
    assert got == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert not list(tokens.batches(pa.array([], pa.string())))


def test_table_grows_and_known_tokens_count_one(library):
    tokens = pretokens.PreTokens(tokenizer_path(), 8, whole_tokens(tokenizer_path()))
    words = [f"w{i}x" for i in range(20_000)] + ["the", "hello", "internationalization"]
    text = " ".join(words)
    (_, _, n, _), = tokens.batches(pa.array([text]))
    assert n.tolist() == [len(library.encode(text, add_special_tokens=False).ids)]
