"""The sum over all segmentations against their enumeration, and words of any length."""

import random
from decimal import Decimal

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from sunledger.llm import language

LONG = b"abcabcabcabcabcabcabcabca"


@pytest.fixture(scope="module")
def small():
    pieces = language.Pieces(sorted({bytes([b]) for b in range(256)} | {b" a", b"ab", b"abc", b" abcab", b"bc", b"cab" * 5, LONG}))
    p = np.random.default_rng(1).random((len(pieces.pieces) + 1, 3))
    p[-1] = 0
    return pieces, p / p.sum(0)


def raw(word):
    return np.frombuffer(word, np.uint8)


def one(word):
    return language.words_of(raw(word), np.array([0]), np.array([len(word)]))


def segmentations(word, pieces):
    if not word:
        return [[]]
    return [[word[:k], *rest] for k in range(1, len(word) + 1) if word[:k] in pieces for rest in segmentations(word[k:], pieces)]


@pytest.mark.parametrize("word", [b"a", b"abcab", b"abcabcab", b"xyz", b"cab" * 5])
def test_forward_and_expected_equal_enumeration(small, word):
    pieces, p = small
    number = {x: i for i, x in enumerate(pieces.pieces)}
    ways = segmentations(b" " + word, number)
    each = np.array([np.prod([p[number[x]] for x in s], axis=0) for s in ways])
    assert np.allclose(language.forward(one(word), pieces, p)[0], each.sum(0), rtol=1e-12)
    for k in range(3):
        want = np.zeros(len(p))
        for s, share in zip(ways, each[:, k] / each[:, k].sum(), strict=True):
            for x in s:
                want[number[x]] += 2 * share
        assert np.allclose(language.expected(one(word), np.array([2]), pieces, p[:, k]), want, atol=1e-12)


def exact(word, pieces, p, k):
    number = {x: i for i, x in enumerate(pieces.pieces)}
    sums = [Decimal(1)] + [Decimal(0)] * len(word)
    for t in range(1, len(word) + 1):
        for size in range(1, min(t, len(LONG)) + 1):
            if word[t - size : t] in number:
                sums[t] += sums[t - size] * Decimal(float(p[number[word[t - size : t]], k]))
    return float(sums[-1].ln())


def test_words_of_any_length_are_summed_whole(small, monkeypatch):
    """Piece by piece over every place, also where a fixed width would cut; products far below the smallest double."""
    pieces, p = small
    monkeypatch.setattr(language, "_STRETCH", 50)
    r = random.Random(1)
    words = [b"abcab" * 30, bytes(r.choices(b"abcxyz", k=500)), b"x" * 31, LONG + LONG, *[bytes(r.choices(b"abcxyz", k=r.randrange(20, 300))) for _ in range(40)]]
    want = np.array([[exact(b" " + w, pieces, p, k) for k in range(3)] for w in words])
    assert np.allclose([language.forward_long(raw(b" " + w), pieces, p) for w in words], want, rtol=1e-9)
    data, lengths = raw(b"".join(words)), np.array(list(map(len, words)))
    batch = language.words_of(data, np.cumsum(lengths) - lengths, lengths, int(lengths.max()) + 1)
    assert np.allclose(language.forward_scaled(batch, pieces, p), want[batch.order], rtol=1e-9)
    text = b" ".join(words)
    known = language._Known(language.Model(["a", "b", "c"], pieces, p))
    for _ in range(2):  # anew and from what is known
        h, at, n, _ = language.words_in(raw(text), np.array([0, len(text)]))
        assert np.allclose(known.of(h, raw(text), at, n), want, rtol=1e-9)


def test_all_pieces_of_the_vocabulary_are_used():
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, pieces = SentencePieceProcessor(model_file=path), set(language.vocabulary(path).pieces)
    texts = [model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    assert max(map(len, texts)) > 8 and set(texts) <= pieces and all(bytes([b]) in pieces for b in range(256))
