import random

import numpy as np
import pytest
from tidemark.llm import tokens

SIGNS = ["a", "B", "é", "×", "÷", "À", ".", ",", "\n", " ", "'", "'s", "1", "½", "中", "\t", "-", "<", "́", "̸", "Σ", "\xa0", "~"]


class Counting:
    """The library's model, with the parts asked of it."""

    def __init__(self, model):
        self.model, self.parts = model, []

    def tokenize(self, part):
        self.parts.append(part)
        return self.model.tokenize(part)


@pytest.mark.parametrize("vocabulary", [tokens.BYTE_VOCABULARY, tokens.WORD_VOCABULARY])
def test_signs_behind_a_word_do_not_make_it_new(vocabulary):
    encoder = tokens.Encoder(vocabulary)
    encoder.model = Counting(encoder.model)
    texts = ["x word word, word. word! word? word; word: x", "x word: größe, größe größe; größe.\nx\nword, x"]
    for _ in range(2):
        ids = [x.tolist() for x in encoder.encode(texts)]
        assert ids == [x.ids for x in encoder.library.encode_batch(texts, add_special_tokens=False)]
    parts = [p for p in encoder.model.parts if p.isalpha()]
    # Words of the word vocabulary are asked for with a space before them and without.
    assert all(parts.count(p) <= 1 + (vocabulary == tokens.WORD_VOCABULARY) for p in parts)


@pytest.mark.parametrize("vocabulary", [tokens.BYTE_VOCABULARY, tokens.WORD_VOCABULARY])
def test_cuts_change_no_ids(vocabulary):
    rng = random.Random(7)
    texts = ["".join(rng.choices(SIGNS, k=rng.randint(0, 9))) for _ in range(3000)]
    encoder = tokens.Encoder(vocabulary)
    got = [x.tolist() for x in encoder.encode(texts)]
    assert got == [x.ids for x in encoder.library.encode_batch(texts, add_special_tokens=False)]


def test_known_pieces_stay_within_their_bytes():
    encoder = tokens.Encoder(tokens.BYTE_VOCABULARY, cache=5_000)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"word{chr(97 + a)}{chr(97 + b)}" for a, b in rng.integers(0, 26, (200, 2))) for _ in range(20)]
    want = [x.ids for x in encoder.library.encode_batch(texts, add_special_tokens=False)]
    for text, ids in zip(texts, want, strict=True):
        assert next(iter(encoder.encode([text]))).tolist() == ids
        assert encoder.known.names.nbytes + encoder.known.values.nbytes <= 5_000
