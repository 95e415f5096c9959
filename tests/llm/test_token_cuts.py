"""Texts are cut into chunks as one array of bytes."""

import random

import numpy as np
import pytest
from odd_texts import ODD_TEXTS
from test_token_operators import BYTE, WORD, plain

from forktide.llm.tokens import Encoder, public_path

PARTS = [
    *" \n\n\r\t a'sé.,|<>1-", *"\u0085  　​ ᠎́İiKſ×÷ёЯԀ日“≠\x1c\x1f", "<|endoftext|>", "<|startoftext|>", " the", ".\n", "word", "'ll", "'re",
]


class Counting:
    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def encode_batch_fast(self, texts, **more):
        self.given += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **more)


@pytest.mark.parametrize("name, text", [(BYTE, "{},\n{}"), (WORD, "{},{}")])
def test_words_met_before_go_to_the_library_once(name, text):
    words = [a + b for a in ("alpha", "beta", "gamma", "déjà", "яблоко") for b in ("tion", "ing", "ness", "ère", "ов")]
    texts = [text.format(a, b) for a in words for b in words]
    encoder = Encoder(public_path(name))
    encoder.tokenizer = Counting(encoder.tokenizer)
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == plain(name, texts)
    assert encoder.tokenizer.given < 5 * sum(map(len, words)) < sum(map(len, texts)) / 5


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_cuts_beside_odd_characters(name):
    rnd, encoder = random.Random(11), Encoder(public_path(name))
    for _ in range(4):
        texts = [*ODD_TEXTS, *("".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 60))) for _ in range(1000))]
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == plain(name, texts)
    assert encoder.encode([]) == [] and encoder.encode([None, ""]) == [b"", b""]
