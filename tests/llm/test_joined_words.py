"""Words that go to the tokenizer together, and the places of Simple-8b words."""

import random
import sys
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tablecheck.llm import simple8b, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, plain):
        self.plain, self.texts = plain, 0

    def encode_batch(self, texts, **options):
        self.texts += len(texts)
        return self.plain.encode_batch(texts, **options)

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.plain.encode_batch_fast(texts, **options)


def ids_of(encoder, texts):
    found = encoder.block(pa.array(texts))
    return [found.ids[a:b].tolist() for a, b in zip(found.starts[:-1], found.starts[1:])]


def whole(texts):
    plain = tokens.Encoder(PATH, True).tokenizer
    return [[*e.ids, 0] for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_words_go_to_the_tokenizer_together():
    """Before, every distinct word was a text of its own."""
    rng = random.Random(51)
    texts = [" ".join("".join(rng.choices("etaoinshrdluéß", k=rng.randint(1, 9))) for _ in range(300)) for _ in range(10)]
    encoder = tokens.Encoder(PATH, True)
    encoder.tokenizer = Counting(encoder.tokenizer)
    assert ids_of(encoder, texts) == whole(texts)
    assert encoder.tokenizer.texts < 50


def test_words_of_any_letters():
    """Also letters that only one side's tables know; several words of each, between words of others."""
    letters = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == "L"]
    rng = random.Random(52)
    some = [*rng.sample(letters, 3000), *letters[-1500:]]
    texts = [" ".join(rng.choice(("", "a", "ab")) + c + rng.choice(("", "b", "é")) for c in some[k : k + 100]) for k in range(0, len(some), 100)]
    assert ids_of(tokens.Encoder(PATH, True), texts) == whole(texts)


def test_a_word_that_is_cut_sends_its_group_word_by_word():
    encoder = tokens.Encoder(PATH, True)
    units = [" one", " two", " don't", " three"]
    flat, sizes = encoder._joined(units)
    alone, each = encoder._alone(units)
    assert flat.tolist() == alone.tolist() and sizes.tolist() == each.tolist()


@pytest.mark.parametrize("n", [0, 1, 2, 31, 32, 33, 1000])
def test_chain_from_zero(n):
    rng = np.random.default_rng(n)
    for step in (rng.integers(1, 121, n), rng.integers(1, 4, n), np.ones(n, np.int64)):
        expected, at = [], 0
        while at < n:
            expected.append(at)
            at += int(step[at])
        assert simple8b.chain_from_zero(step).tolist() == expected
