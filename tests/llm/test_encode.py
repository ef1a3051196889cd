"""The encoder's word cache against plain encoding."""

import numpy as np
import public_tokenizers
import pytest
from sunledger.llm import encode

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("words, size", [(3, 1 << 20), (1000, 400)])
def test_words_that_outgrow_the_cache(monkeypatch, words, size):
    monkeypatch.setattr(encode, "CACHED_WORDS", words)
    monkeypatch.setattr(encode, "CACHED_BYTES", size, raising=False)
    encoder = encode.Encoder(BPE)
    for texts in (["alpha\nbeta"], ["alpha\ngamma\ndelta"], ["beta\nalpha", "日本語のテキスト\nalpha"], ["alpha one two", "beta one three four"], ["x" * 500 + "\nalpha"], ["alpha one"]):
        raw = [t.encode() for t in texts]
        ids, ends = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        got = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        used = {w for t in texts for line in t.split("\n") for w in line.split(" ")}
        assert len(encoder.units) <= max(words, len(used))
        assert encoder.held <= max(size, 2000)


def test_texts_of_all_kinds():
    """Empty texts, odd white space, many words at once, words that come again as first of a line, of a text and later."""
    encoder = encode.Encoder(BPE)
    many = " ".join(f"word{i}" for i in range(1000))
    for texts in ([], [""], ["", "a", ""], [" a", "a ", "a  b", "a\n\nb", "a\tb", "a\u00a0b", "a\u2003b", "é à", "\n"], [many, many.replace(" ", "\n"), many], ["x\ny z\nx y", "y", "x"], ["<|endoftext|> a"]):
        raw = [t.encode() for t in texts]
        for _ in range(2):  # learned and known
            ids, ends = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
            got = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
