"""Operator 1: licence scans of whole texts, paragraph by paragraph.

Lines up to a blank one are a paragraph, and so is each blank line.  Lines and overlapping windows of a paragraph's words
are told apart by a multinomial logistic regression over hashed word 1- to 3-grams.  It is trained here, on variants of the
templates below and on a bounded sample of the corpus' own lines and windows; a fold left out sets the temperature of its
probabilities and the least probability that is not ``unknown``.  Windows of one family that touch are one notice, and it
counts as confirmed when the words around it hold enough of the word 3-grams of one of the family's templates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm import common
from sunledger.llm.decontaminate import _LOWERED

SLOTS = 1 << 15
GRAMS = 3
#: About how many of the corpus' lines and windows the classifier sees at most, one of a document.
FIT_PARAGRAPHS = 3000
#: Share of a template's word 3-grams that confirms a prediction.
CONFIRMED = 0.6
#: Words of windows, each half over the one before; a shorter paragraph is one window.
WIDTHS = (8, 16, 32)
#: Times a template's length within which its 3-grams are counted together.
SLACK = 2
#: Share of a line's or window's own 3-grams in templates from which it is no example of the unknown class.
OWN = 0.25
STEPS, RATE, RIDGE = 300, 0.5, 1e-4

#: Usual notices of licence families.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
        "Licensed under CC BY-NC-ND 4.0.",
    ),
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright 2020 The Authors. All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher.",
    ),
}
FAMILIES = tuple(TEMPLATES)
UNKNOWN = len(FAMILIES)

#: Sentences with words of notices that are none.
_NOT_NOTICES = (
    "He lost his driving license after the accident.",
    "The license plate was reported to the police.",
    "All rights must be defended, she said.",
    "Permission to land was granted by the tower.",
    "The general public was not admitted.",
    "A free copy of the report can be obtained at the office.",
    "Seats are reserved for members of the foundation.",
    "The warranty of the car has run out.",
    "Version 3 of the plan was released under the old name.",
    "The Apache helicopter was tested in the desert.",
)
_BEFORE = ("", "Notice: ", "Copyright (c) 2021 A. Writer. ", "# ", "-- ", "Terms of use: ", "This text is ", "(c) 2019 Example Ltd. ")
_AFTER = ("", " See LICENSE for details.", " Thank you for reading.", " https://example.com/terms", " Contact us for more.")


def _hashes(words: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the 1-grams, 2-grams, ... that start at each word (where there are so many)."""
    for k in range(1, GRAMS + 1):
        n = max(0, len(words) - k + 1)
        h = np.full(n, np.uint64(k))
        for j in range(k):
            h = common.mix(h * np.uint64(0x9E3779B97F4A7C15) + words[j : j + n])
        yield h


def _slots(h: np.ndarray) -> np.ndarray:
    return (h % np.uint64(SLOTS)).astype(np.int64)


def features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of the n-grams of each row, their rows, and hashes of the 3-grams apart: ``(slot, row, 3-gram or 0)``."""
    words, rows = common.hashed_words(data, ends, _LOWERED)
    slots, at, threes = [], [], []
    word_row = np.repeat(np.arange(len(ends) - 1), np.diff(rows))
    for k, h in enumerate(_hashes(words), 1):
        n = len(h)
        same = word_row[:n] == word_row[k - 1 :]
        h, row = h[same], word_row[:n][same]
        slots.append(_slots(h))
        at.append(row)
        threes.append(h if k == GRAMS else np.zeros(len(h), np.uint64))
    return np.concatenate(slots), np.concatenate(at), np.concatenate(threes)


def _bytes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


class Units:
    """Words of a chunk, its paragraphs, and lines and windows of their words in the order of their starts."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        lines = np.union1d(np.flatnonzero(data == 0x0A) + 1, ends)
        filled = np.diff(np.concatenate([[0], np.cumsum(~common.SPACE[data])])[lines]) > 0
        border = np.ones(len(lines), bool)
        border[1:-1] = ~(filled[1:] & filled[:-1])
        cuts = np.union1d(lines[border], ends)
        #: How many paragraphs lie before each row's end.
        self.upto = np.searchsorted(cuts, ends)
        self.words, line_words = common.hashed_words(data, lines, _LOWERED)
        #: Word ends of the paragraphs.
        self.ends = line_words[np.searchsorted(lines, cuts)]
        n = np.diff(self.ends)
        starts, stops = [line_words[:-1]], [line_words[1:]]
        for w in WIDTHS:
            many = np.where(n > w, -(-(n - w) // (w // 2)) + 1, 1)
            of = np.repeat(np.arange(len(n)), many)
            start = self.ends[:-1][of] + (np.arange(len(of)) - (np.cumsum(many) - many)[of]) * (w // 2)
            start = np.minimum(start, self.ends[:-1][of] + np.maximum(n[of] - w, 0))
            starts.append(start)
            stops.append(np.minimum(start + w, self.ends[1:][of]))
        start, stop = np.concatenate(starts), np.concatenate(stops)
        key = np.unique((start * (len(self.words) + 1) + stop)[start < stop])
        self.start, self.stop = key // (len(self.words) + 1), key % (len(self.words) + 1)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Class scores of lines and windows: weights of their n-grams over the root of their number."""
        out, counts = np.zeros((len(self.start), weights.shape[1])), np.zeros(len(self.start))
        for k, h in enumerate(_hashes(self.words), 1):
            total = np.zeros((len(h) + 1, weights.shape[1]))
            np.cumsum(weights[_slots(h)], 0, out=total[1:])
            some = np.flatnonzero(self.stop - self.start >= k)
            lo, hi = self.start[some], self.stop[some] - k + 1
            out[some] += total[hi] - total[lo]
            counts[some] += hi - lo
        return out / np.sqrt(np.maximum(counts, 1))[:, None]


def _sums(slots: np.ndarray, row: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Class scores of rows: weights of their n-grams over the root of their number."""
    order = np.argsort(row, kind="stable")
    counts = np.bincount(row, minlength=n)
    total = np.concatenate([np.zeros((1, weights.shape[1])), np.cumsum(weights[slots[order]], 0)])
    stop = np.cumsum(counts)
    return (total[stop] - total[stop - counts]) / np.sqrt(np.maximum(counts, 1))[:, None]


@dataclass
class Model:
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float
    templates: list[list[np.ndarray]]

    def probabilities(self, units: Units) -> np.ndarray:
        z = (units.scores(self.weights) + self.bias) / self.temperature
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def closest(self, family: int, threes: np.ndarray, start: int, stop: int, lo: int, hi: int) -> tuple[float, int, int]:
        """Largest share of a template's 3-grams found together around the words from ``start`` to ``stop`` of the paragraph
        from ``lo`` to ``hi``, and where."""
        best = (0.0, start, stop)
        for t in self.templates[family]:
            reach = len(t) + GRAMS - 1
            a, b = max(lo, start - reach), max(lo, min(hi, stop + reach) - GRAMS + 1)
            at = a + np.flatnonzero(np.isin(threes[a:b], t))
            if not len(at) or len(np.unique(threes[at])) <= best[0] * len(t):
                continue
            ends = np.searchsorted(at, at + SLACK * reach)
            for i, j in enumerate(ends.tolist()):
                if j - i > best[0] * len(t) and (share := len(np.unique(threes[at[i:j]])) / len(t)) > best[0]:
                    best = (share, int(at[i]), int(at[j - 1]) + GRAMS)
        return best

    def notices(self, hits: list[tuple[int, int, int, float]], threes: np.ndarray, lo: int, hi: int) -> list[tuple]:
        """``(start, family, probability, share)`` of a paragraph's notices from its hits ``(family, start, stop, probability)``.

        Of families that match the same words the one with the largest share stays.  What is not confirmed stays where
        nothing else is.
        """
        spans: list[list] = []
        for family, start, stop, p in sorted(hits):
            if spans and spans[-1][0] == family and start <= spans[-1][2]:
                spans[-1][2:] = [max(stop, spans[-1][2]), max(p, spans[-1][3])]
            else:
                spans.append([family, start, stop, p])
        found = [(*self.closest(f, threes, a, b, lo, hi), f, a, b, p) for f, a, b, p in spans]
        taken, out = [], []
        for share, first, last, f, a, b, p in sorted(found, key=lambda x: (-x[0], -x[6], x[3], x[4])):
            x, y = (first, last) if share >= CONFIRMED else (a, b)
            most = (y - x) // 2 if share >= CONFIRMED else 0
            if all(min(y, d) - max(x, c) <= most for c, d in taken):
                taken.append((x, y))
                out.append((x, f, p, share))
        return sorted(out)


def _variants() -> tuple[list[str], list[int]]:
    texts, labels = list(_NOT_NOTICES), [UNKNOWN] * len(_NOT_NOTICES)
    for label, family in enumerate(FAMILIES):
        for text in TEMPLATES[family]:
            for before in _BEFORE:
                for after in _AFTER:
                    for shown in (text, text.upper()):
                        texts.append(before + shown + after)
                        labels.append(label)
            words = text.split()
            if len(words) > 12:  # notices broken over lines
                for lo in range(0, len(words) - 8, 4):
                    texts.append(" ".join(words[lo : lo + 12]))
                    labels.append(label)
    return texts, labels


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct slots of one line or window of each document, that with the least hash, and whether it is like a template."""
    templates = [t for f in _template_grams() for t in f]
    every = np.unique(np.concatenate(templates))
    for _, data, ends in common.chunks(batches):
        units = Units(data, ends)
        words, hashes = units.words, list(_hashes(units.words))
        h = common.mix(words[units.start] + common.mix(words[units.stop - 1] + (units.stop - units.start).astype(np.uint64)))
        edges = np.searchsorted(units.start, units.ends[units.upto])
        out, like = [], []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if a < b:
                i = a + int(h[a:b].argmin())
                lo, hi = int(units.start[i]), int(units.stop[i])
                out.append(np.unique(np.concatenate([_slots(x[lo : max(lo, hi - k)]) for k, x in enumerate(hashes)])))
                threes = hashes[-1][lo : max(lo, hi - GRAMS + 1)]
                mine = np.isin(threes, every).mean() >= OWN if len(threes) else False
                like.append(1.0 if mine else max(float(np.isin(t, threes).mean()) for t in templates if len(t)))
        yield common.batch_of({"slots": pa.array(out, pa.list_(pa.int64())), "like": pa.array(like, pa.float64())})


def _template_grams() -> list[list[np.ndarray]]:
    out = []
    for family in FAMILIES:
        grams = []
        for text in TEMPLATES[family]:
            _, _, threes = features(*_bytes_of([text]))
            grams.append(np.unique(threes[threes != 0]))
        out.append(grams)
    return out


def fit(docs: DataFrame, fit_paragraphs: int = FIT_PARAGRAPHS) -> Model:
    """Train on variants of the templates and, as the unknown class, on about ``fit_paragraphs`` lines and windows of ``docs`` at most.

    Those that hold half of a template, or whose own 3-grams are templates' from ``OWN`` on, are no examples of the unknown class.
    """
    common.shipped(docs.sparkSession)
    rows = common.keyed(docs, "doc_id", "text").where("text is not null")
    share = min(1.0, fit_paragraphs / max(1, rows.count()))
    sample = rows.where(F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    got = sample.mapInArrow(_sampled, "slots array<long>, like double").where("like < 0.5 and size(slots) > 0").toArrow()
    own = [np.array(x, np.int64) for x in got.column("slots").to_pylist()]

    texts, labels = _variants()
    slots, row, _ = features(*_bytes_of(texts))
    n = len(texts)
    slots = np.concatenate([slots, *own])
    row = np.concatenate([row, np.repeat(np.arange(n, n + len(own)), [len(x) for x in own])])
    y = np.array(labels + [UNKNOWN] * len(own))
    n += len(own)
    left_out = common.mix(np.arange(n, dtype=np.uint64)) % np.uint64(4) == 0
    weights, bias = _descend(slots, row, y, ~left_out)
    model = Model(weights, bias, 1.0, 0.5, _template_grams())

    z = (_sums(slots, row, weights, n) + bias)[left_out]
    truth = y[left_out]

    def loss(t: float) -> float:
        s = z / t
        return float((np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(s)), truth]).mean())

    model.temperature = min((0.1, 0.15, 0.25, 0.4, 0.6, 1.0, 1.5, 2.5, 4.0), key=loss)
    p = np.exp((z - z.max(1, keepdims=True)) / model.temperature)
    p /= p.sum(1, keepdims=True)
    wrong = p[truth == UNKNOWN, :UNKNOWN].max(1, initial=0)
    model.least = float(min(0.95, max(0.5, wrong.max(initial=0))))
    return model


def _descend(slots: np.ndarray, row: np.ndarray, y: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Full-batch gradient descent with per-weight rates; classes weigh alike."""
    n, classes = len(y), UNKNOWN + 1
    keep = use[row]
    order = np.argsort(slots[keep], kind="stable")
    slots, row = slots[keep][order], row[keep][order]
    size = np.sqrt(np.maximum(np.bincount(row, minlength=n), 1))
    used, first = np.unique(slots, return_index=True)
    back = np.repeat(np.arange(len(used)), np.diff(np.append(first, len(slots))))
    by_row = np.argsort(row, kind="stable")
    rows, start = np.unique(row[by_row], return_index=True)
    share = 1 / np.bincount(y[rows], minlength=classes).clip(1)[y[rows]] / classes
    target = np.eye(classes)[y[rows]]
    number = np.zeros(n, np.int64)
    number[rows] = np.arange(len(rows))
    w, b = np.zeros((len(used), classes)), np.zeros(classes)
    gw, gb = np.full_like(w, 1e-8), np.full_like(b, 1e-8)
    for _ in range(STEPS):
        z = np.add.reduceat(w[back[by_row]], start, 0) / size[rows][:, None] + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = (p - target) * share[:, None]
        dw = np.add.reduceat((g / size[rows][:, None])[number[row]], first, 0) + RIDGE * w
        db = g.sum(0)
        gw += dw * dw
        gb += db * db
        w -= RATE * dw / np.sqrt(gw)
        b -= RATE * db / np.sqrt(gb)
    out = np.zeros((SLOTS, classes))
    out[used] = w
    return out, b


def _scanned(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, data, ends in common.chunks(batches, limit=1 << 20):
            units = Units(data, ends)
            found: list[list[dict]] = [[] for _ in range(some.num_rows)]
            if len(units.start):
                p = model.probabilities(units)
                family = p.argmax(1)
                hits = np.flatnonzero((family != UNKNOWN) & (p.max(1) >= model.least))
                *_, threes = _hashes(units.words)
                of = np.searchsorted(units.ends, units.start[hits], "right") - 1
                for k in np.unique(of).tolist():
                    mine = hits[np.searchsorted(of, k) : np.searchsorted(of, k, "right")]
                    rows = list(zip(family[mine].tolist(), units.start[mine].tolist(), units.stop[mine].tolist(), p[mine].max(1).tolist(), strict=True))
                    d = int(np.searchsorted(units.upto, k, "right")) - 1
                    for _, f, prob, like in model.notices(rows, threes, int(units.ends[k]), int(units.ends[k + 1])):
                        found[d].append({"paragraph": k - int(units.upto[d]), "family": FAMILIES[f], "probability": prob, "template": like, "confirmed": like >= CONFIRMED})
            kinds = pa.list_(pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("template", pa.float64()), ("confirmed", pa.bool_())]))
            yield common.batch_of({"doc_id": some.column("doc_id"), "n_paragraphs": np.diff(units.upto), "notices": pa.array(found, kinds)})

    return run


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_paragraphs, notices`` of every row; a notice has its paragraph's place, family, probability, the share of the
    closest template and whether that confirms it.

    A null or empty text has no paragraph.  Of families with equal probability the first wins.
    """
    common.shipped(docs.sparkSession)
    notices = "array<struct<paragraph: long, family: string, probability: double, template: double, confirmed: boolean>>"
    return common.keyed(docs, "doc_id", "text").mapInArrow(_scanned(model), f"doc_id long, n_paragraphs long, notices {notices}")
