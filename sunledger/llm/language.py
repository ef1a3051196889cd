"""Operator 3: language of texts by segmentation-marginalised unigrams.

A language is a distribution over the pieces of a fixed public vocabulary.  The probability of a word (with the space
before it) is the sum over all its segmentations into pieces, by the forward algorithm; that of a text is the product over
its words.  The distributions are learned by expectation maximisation over the words of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from sunledger.llm import common

#: Words of at most RUN bytes, the space before them included, are summed up many at a time; longer ones one by one with a
#: scale, as their products would underflow.
RUN = 32
#: Steps of a long word after which its sums are scaled, and bytes of it whose pieces are looked up at once.
_SCALED, _STRETCH = 16, 1 << 16
#: Bytes of long words that are summed up together, and how many words make that worth while.
_TOGETHER, _FEW = 1 << 19, 24
#: About how many labelled texts a language is learned from at most.
FIT_DOCUMENTS = 1500
ITERATIONS = 3
SMOOTH = 0.5
CACHED_WORDS = 500_000
UNKNOWN = "und"
#: A Unicode letter; digits and other signs that stand for numbers are none.
LETTER = r"\p{L}"


class Pieces:
    """Pieces of a vocabulary by hash, in an open-addressed table; all single bytes are pieces."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([0, *map(len, pieces)])
        #: lengths that pieces have
        self.sizes = np.unique(np.diff(ends))
        self.powers = np.cumprod(np.full(int(self.sizes.max(initial=1)), 0xD6E8FEB86659FD93, np.uint64))
        self.mask = np.uint64((1 << 19) - 1)
        self.keys, self.index, self.depth = np.zeros(1 << 19, np.uint64), np.full(1 << 19, len(pieces), np.int32), 1
        powers = self.powers
        for i in range(len(pieces)):
            text = data[ends[i] : ends[i + 1]]
            h = int(common.mix(np.array([(text.astype(np.uint64) + np.uint64(1)) @ powers[: len(text)]]))[0])
            d = 0
            while self.index[(h + d) & int(self.mask)] != len(pieces):
                d += 1
            self.keys[(h + d) & int(self.mask)], self.index[(h + d) & int(self.mask)] = h, i
            self.depth = max(self.depth, d + 1)

    def find(self, raw: np.ndarray) -> np.ndarray:
        """Index of each piece by its polynomial, or the number of pieces."""
        h = common.mix(raw)
        out = np.full(len(h), len(self.pieces), np.int32)
        for d in range(self.depth):
            at = ((h + np.uint64(d)) & self.mask).astype(np.int64)
            hit = self.keys[at] == h
            out[hit] = self.index[at[hit]]
        return out


def vocabulary(path: str) -> Pieces:
    """All pieces of a SentencePiece model, its word mark as a space, and all single bytes."""
    model = SentencePieceProcessor(model_file=path)
    found = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            text = model.id_to_piece(i).replace("▁", " ").encode()
            if text:
                found.add(text)
    return Pieces(sorted(found))


@dataclass
class Words:
    """Distinct words, longest first: a row of ``RUN`` bytes for each and its length."""

    rows: np.ndarray
    lengths: np.ndarray

    def steps(self, pieces: Pieces):
        """For each end and piece length: how many rows (from the first) reach it, and their pieces there."""
        powers, wide = pieces.powers, self.rows.astype(np.uint64) + np.uint64(1)
        for t in range(1, self.rows.shape[1] + 1):
            n = int(np.searchsorted(-self.lengths, -t, "right"))
            if not n:
                return
            for size in pieces.sizes[pieces.sizes <= t].tolist():
                yield t, size, n, pieces.find(wide[:n, t - size : t] @ powers[:size])


def words_in(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and length of every word, and the word ends of the rows."""
    starts, stops, rows = common.word_spans(~common.SPACE[data], ends)
    return common.Prefix(data).ranges(starts, stops), starts, stops - starts, rows


def words_of(data: np.ndarray, at: np.ndarray, lengths: np.ndarray, width: int = RUN) -> Words:
    """Words of less than ``width`` bytes, each with a space before it."""
    order = np.argsort(-lengths, kind="stable")
    start, lengths = at[order], lengths[order]
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    place = np.arange(width)[None, :] - 1
    rows = np.where((place >= 0) & (place < lengths[:, None]), padded[np.minimum(start[:, None] + np.maximum(place, 0), len(padded) - 1)], 0).astype(np.uint8)
    rows[:, 0] = 0x20
    words = Words(rows, lengths + 1)
    words.order = order
    return words


def forward_scaled(words: Words, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """As ``forward``, of words of any length and as logarithms: only the sums that a piece can reach back to are held."""
    longest, n = int(pieces.sizes[-1]), len(words.lengths)
    held = [np.ones((n, p.shape[1]))]
    logs, out = np.zeros((n, p.shape[1])), np.zeros((n, p.shape[1]))
    for t, group in groupby(words.steps(pieces), key=lambda x: x[0]):
        now = None
        for _, size, live, index in group:
            step = held[-size][:live] * p[index]
            now = step if now is None else now + step
        held = [*held[1 - longest :], now]
        done = int(np.searchsorted(-words.lengths, -t, "left"))
        out[done : len(now)] = logs[done : len(now)] + np.log(now[done:])
        if t % _SCALED == 0:
            scale = np.max([h[:done] for h in held], axis=0)
            held = [h[:done] / scale for h in held]
            logs[:done] += np.log(scale)
    return out


def forward_long(word: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Logarithm of the sum over all segmentations of a word of any length, by language; what lies behind the longest piece is let go."""
    sizes, longest = pieces.sizes, int(pieces.sizes[-1])
    before = longest - sizes
    window, logs = np.zeros((longest, p.shape[1])), np.zeros(p.shape[1])
    window[-1] = 1
    wide = np.concatenate([np.zeros(longest, np.uint64), word.astype(np.uint64) + np.uint64(1)])  # 0 is in no piece
    for lo in range(0, len(word), _STRETCH):
        n = min(_STRETCH, len(word) - lo)
        index = np.empty((n, len(sizes)), np.int32)
        for j, size in enumerate(sizes.tolist()):
            ending = wide[lo + longest - size + 1 : lo + longest + n]
            index[:, j] = pieces.find(np.lib.stride_tricks.sliding_window_view(ending, size) @ pieces.powers[:size])
            index[: max(min(size - 1 - lo, n), 0), j] = len(pieces.pieces)
        for t in range(n):
            now = (window[before] * p[index[t]]).sum(0)
            window[:-1] = window[1:]
            window[-1] = now
            if t % _SCALED == _SCALED - 1:
                scale = window.max(0)
                window /= scale
                logs += np.log(scale)
    return logs + np.log(window[-1])


def forward(words: Words, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Sum over all segmentations of each word by language: ``p`` has a column for each language, a zero row at the end."""
    alpha = np.zeros((RUN + 1, len(words.lengths), p.shape[1]))
    alpha[0] = 1
    for t, size, n, index in words.steps(pieces):
        alpha[t, :n] += alpha[t - size, :n] * p[index]
    return alpha[words.lengths, np.arange(len(words.lengths))]


def expected(words: Words, counts: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of words with counts, for one language (forward and backward)."""
    steps = list(words.steps(pieces))
    n_words = len(words.lengths)
    alpha, beta = np.zeros((RUN + 1, n_words)), np.zeros((RUN + 1, n_words))
    alpha[0] = 1
    for t, size, n, index in steps:
        alpha[t, :n] += alpha[t - size, :n] * p[index]
    whole = alpha[words.lengths, np.arange(n_words)]
    beta[words.lengths, np.arange(n_words)] = 1
    uses = np.zeros(len(p))
    share = counts / np.maximum(whole, 1e-300)
    for t, size, n, index in reversed(steps):
        flow = p[index] * beta[t, :n]
        uses += np.bincount(index, alpha[t - size, :n] * flow * share[:n], minlength=len(p))
        beta[t - size, :n] += flow
    return uses


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some, data, ends in common.chunks(batches):
        lang = np.array(some.column("lang").to_pylist(), object)
        h, at, lengths, rows = words_in(data, ends)
        kinds, kind = np.unique(lang.astype(str), return_inverse=True)
        row = np.repeat(np.arange(len(lang)), np.diff(rows))
        for k, name in enumerate(kinds):
            mine = np.flatnonzero((kind[row] == k) & (lengths < RUN))
            _, first, n = np.unique(h[mine], return_index=True, return_counts=True)
            words = words_of(data, at[mine[first]], lengths[mine[first]])
            text = [r[:m].tobytes() for r, m in zip(words.rows, words.lengths.tolist(), strict=True)]
            yield common.batch_of({"lang": pa.array([str(name)] * len(text), pa.string()), "word": pa.array(text, pa.binary()), "n": n[words.order]})


def _stacked(batch: pa.RecordBatch) -> tuple[Words, np.ndarray]:
    text = batch.column("word").to_pylist()
    lengths = np.array([len(t) for t in text], np.int64)
    order = np.argsort(-lengths, kind="stable")
    rows = np.zeros((len(text), RUN), np.uint8)
    for k, i in enumerate(order.tolist()):
        rows[k, : len(text[i])] = np.frombuffer(text[i], np.uint8)
    return Words(rows, lengths[order]), order


def _expectation(pieces: Pieces, langs: list[str], p: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.forget()
        uses = np.zeros(p.shape)
        for batch in batches:
            words, order = _stacked(batch)
            lang, n = np.array(batch.column("lang").to_pylist(), object)[order], batch.column("n").to_numpy()[order]
            for k, name in enumerate(langs):
                mine = lang == name
                if mine.any():
                    uses[:, k] += expected(Words(words.rows[mine], words.lengths[mine]), n[mine], pieces, p[:, k])
        piece, k = np.nonzero(uses)
        yield common.batch_of({"piece": pa.array(piece, pa.int32()), "k": pa.array(k, pa.int32()), "uses": uses[piece, k]})

    return run


@dataclass
class Model:
    langs: list[str]
    pieces: Pieces
    p: np.ndarray


def fit(labelled: DataFrame, vocabulary_path: str, fit_documents: int = FIT_DOCUMENTS) -> Model:
    """Learn from rows of ``text`` and ``lang``, of each language about ``fit_documents`` at most, chosen by hash.

    Null texts and languages are left out, and words of ``RUN`` bytes and more.  The driver sees one number for each piece and language.
    """
    spark = common.shipped(labelled.sparkSession)
    pieces = vocabulary(vocabulary_path)
    rows = labelled.where("text is not null and lang is not null").select("text", "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    width = len(pieces.pieces)
    if not langs:
        return Model([], pieces, np.zeros((width + 1, 0)))
    share = F.coalesce(*[F.when(F.col("lang") == x, min(1.0, fit_documents / sizes[x])) for x in langs])
    sample = rows.where(F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 30)) < share * (1 << 30))
    counts = sample.mapInArrow(_counted, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = common.Stage(spark).save(counts, "words")
    p = np.full((width + 1, len(langs)), 1 / width)
    p[width] = 0
    for _ in range(ITERATIONS):
        step = counts.mapInArrow(_expectation(pieces, langs, p), "piece int, k int, uses double").groupBy("piece", "k").agg(F.sum("uses").alias("uses"))
        got = step.toArrow()  # at most pieces * languages rows
        uses = np.full((width + 1, len(langs)), SMOOTH)
        uses[width] = 0
        uses[got.column("piece").to_numpy(), got.column("k").to_numpy()] += got.column("uses").to_numpy()
        p = uses / uses.sum(0)
    return Model(langs, pieces, p)


class _Known:
    """Log-probabilities of words met before in this task, by hash."""

    def __init__(self, model: Model):
        self.model, self.h, self.logs = model, np.zeros(0, np.uint64), np.zeros((0, len(model.langs)))

    def of(self, h: np.ndarray, data: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        distinct, first, back = np.unique(h, return_index=True, return_inverse=True)
        place = np.searchsorted(self.h, distinct)
        new = np.flatnonzero(self.h[np.minimum(place, len(self.h) - 1)] != distinct) if len(self.h) else np.arange(len(distinct))
        logs = np.zeros((len(distinct), len(self.model.langs)))
        old = np.ones(len(distinct), bool)
        old[new] = False
        logs[old] = self.logs[place[old]] if len(self.h) else 0
        short = new[lengths[first[new]] < RUN]
        for lo in range(0, len(short), 20_000):
            mine = short[lo : lo + 20_000]
            words = words_of(data, at[first[mine]], lengths[first[mine]])
            logs[mine[words.order]] = np.log(np.maximum(forward(words, self.model.pieces, self.model.p), 1e-300))
        long = new[lengths[first[new]] >= RUN]
        long = long[np.argsort(lengths[first[long]], kind="stable")]
        while len(long):
            # some words of about one length together, a few very long ones each for itself
            sizes = lengths[first[long]] + 1
            n = max(1, int((np.cumsum(np.ones(len(long), np.int64)) * sizes <= _TOGETHER).sum()))
            mine, long = long[:n], long[n:]
            if n >= _FEW:
                words = words_of(data, at[first[mine]], lengths[first[mine]], int(sizes[n - 1]))
                logs[mine[words.order]] = forward_scaled(words, self.model.pieces, self.model.p)
            else:
                for i in mine.tolist():
                    word = np.concatenate([[np.uint8(0x20)], data[at[first[i]] : at[first[i]] + lengths[first[i]]]])
                    logs[i] = forward_long(word, self.model.pieces, self.model.p)
        if len(self.h) + len(new) > CACHED_WORDS:
            self.h, self.logs = distinct, logs
        elif len(new):
            h = np.concatenate([self.h, distinct[new]])
            order = np.argsort(h, kind="stable")
            self.h, self.logs = h[order], np.concatenate([self.logs, logs[new]])[order]
        return logs[back]


def _predicted(model: Model, keep: tuple[str, ...], out: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(model)
        for some, data, ends in common.chunks(batches):
            has_letter = pc.match_substring_regex(some.column("text"), LETTER).fill_null(False).to_numpy(zero_copy_only=False)
            names, score = np.full(some.num_rows, UNKNOWN, object), np.zeros(some.num_rows)
            if model.langs:
                h, at, lengths, rows = words_in(data, ends)
                sums = np.zeros((len(h) + 1, len(model.langs)))
                np.cumsum(known.of(h, data, at, lengths), 0, out=sums[1:])
                whole = sums[rows[1:]] - sums[rows[:-1]]
                best = whole.argmax(1)
                share = 1 / np.exp(whole - whole.max(1, keepdims=True)).sum(1)
                names[has_letter] = np.array(model.langs, object)[best[has_letter]]
                score[has_letter] = share[has_letter]
            yield common.batch_of({c: some.column(c) for c in keep} | {out[0]: pa.array(names.tolist(), pa.string()), out[1]: score})

    return run


def predict(docs: DataFrame, model: Model, *keep: str, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``lang_pred`` and ``score`` (or other ``names``) (the language's share of the summed probabilities) of every row's whole ``text``.

    Kept columns come first.  A null text, one without a letter, and all texts where no language was learned are ``und``
    with score 0.  Equal shares go to the first language in order of name.
    """
    common.shipped(docs.sparkSession)
    rows = common.keyed(docs, *dict.fromkeys([*keep, "text"]))
    schema = rows.select(*[F.col(f"`{c}`") for c in keep], F.lit("").alias(names[0]), F.lit(0.0).alias(names[1])).schema
    return rows.mapInArrow(_predicted(model, keep, names), schema)
