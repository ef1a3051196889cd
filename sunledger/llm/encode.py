"""Token ids of whole texts by a public tokenizer, with each distinct word encoded once per worker."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from sunledger.llm import common, wordlists

os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores

#: Words kept with their ids in one worker, and bytes of both; beyond either only the words of the last chunk stay.
CACHED_WORDS = 400_000
CACHED_BYTES = 32 << 20
#: Bytes of text that are encoded at once.
CHUNK_BYTES = 4 << 20
#: Words that the tokenizer takes as one text.
_TOGETHER = 256

_PLAIN = np.zeros(256, bool)
_PLAIN[[0x20, 0x0A]] = True
_OTHER = np.zeros(256, bool)
_OTHER[[9, 11, 12, 13, *range(28, 32)]] = True
#: First bytes of white space beyond ASCII, most of them of other characters too.
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _rows_with(places: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows that hold one of the ascending places."""
    upto = np.searchsorted(places, ends)
    return upto[1:] > upto[:-1]


def odd_spaces(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows whose white space is more than one space or one line end between words; those are not encoded word by word."""
    plain = _PLAIN[data]
    hit = _OTHER[data]
    hit[1:] |= plain[1:] & plain[:-1]
    odd = _rows_with(np.flatnonzero(hit), ends)
    filled = np.flatnonzero(np.diff(ends))
    odd[filled] |= plain[ends[:-1][filled]] | plain[ends[1:][filled] - 1]
    for i in np.flatnonzero(_rows_with(np.flatnonzero(_LEADS[data]), ends) & ~odd).tolist():
        odd[i] = any(c.isspace() for c in set(_text(data, ends, i)) if c > "\x7f")
    return odd


def _text(data: np.ndarray, ends: np.ndarray, row: int) -> str:
    return data[ends[row] : ends[row + 1]].tobytes().decode()


class Encoder:
    """Ids of texts by a byte-level BPE file.

    The vocabulary's pre-tokenizer never joins a word with the space or line end after it, so ids of a text are those of
    its units: a word with the space or line end before it.  Distinct units are encoded some hundred at a time, a line end
    between them; texts with other white space are encoded whole.  Units and ids are kept in a few flat arrays.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.uint16 if self.width == 2 else np.uint32
        (self.line,) = self._ids("\n")
        self._keep(pa.array([], pa.large_binary()), np.zeros(0, self.dtype), np.zeros(1, np.int64))

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _keep(self, units: pa.LargeBinaryArray, ids: np.ndarray, ends: np.ndarray) -> None:
        """Units with their ids, and the n+1 ends of these."""
        self.units, self.ids, self.ends = units, ids, ends

    @property
    def held(self) -> int:
        return self.units.nbytes + self.ids.nbytes + self.ends.nbytes

    def _learned(self, units: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct units and their n+1 ends."""
        data, upto = wordlists.bytes_of(units)
        lines = data[upto[:-1]] == 0x0A  # no unit is empty
        starts = upto[:-1] + lines
        words, stops = wordlists.slices(data, starts, upto[1:])
        n = len(units)
        apart = np.full(len(words) + n, 0x0A, np.uint8)
        mask = np.ones(len(apart), bool)
        mask[stops[1:] + np.arange(n)] = False
        apart[mask] = words
        # a space after a line end stays with its word, and a word after one is like that at the start of a text
        edges = [*(stops[:n:_TOGETHER] + np.arange(0, n, _TOGETHER)).tolist(), len(apart)]
        ids, texts = [], ["\n" + apart[a:b].tobytes().decode() for a, b in zip(edges[:-1], edges[1:], strict=True)]
        for k in range(0, len(texts), 16):
            ids += [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts[k : k + 16], add_special_tokens=False)]
        ids = np.concatenate(ids)
        # a line end before each unit, and one more after the last of a text
        line = np.flatnonzero(ids == self.line)
        last = np.zeros(len(line), bool)
        last[np.append(np.arange(_TOGETHER, n + len(texts) - 1, _TOGETHER + 1), n + len(texts) - 1)] = True
        before, after = line[~last], line[1:][~last[:-1]]
        own, ends = wordlists.slices(ids, before + ~lines, after)
        return own, ends

    def _of(self, units: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct units: an array, and where in it each one's start and stop."""
        at = pc.index_in(units, value_set=self.units).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        ids, ends, kept = self.ids, self.ends, len(self.units)
        if len(new):
            more = units.take(pa.array(new))
            own, upto = self._learned(more)
            at[new] = kept + np.arange(len(new))
            ids, ends = np.concatenate([ids, own]), np.concatenate([ends, ends[-1] + upto[1:]])
            if kept + len(new) <= CACHED_WORDS and self.held + more.nbytes + own.nbytes + upto.nbytes <= CACHED_BYTES:
                self._keep(pa.concat_arrays([self.units, more]), ids, ends)
            else:
                self._keep(units, *wordlists.slices(ids, ends[at], ends[at + 1]))
        return ids, ends[at], ends[at + 1]

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, given as their bytes in UTF-8 and their n+1 ends, and the n+1 ends of their ids."""
        odd = odd_spaces(data, ends)
        whole, upto = wordlists.slices(data, ends[:-1][~odd], ends[1:][~odd]) if odd.any() else (data, ends)
        first = np.zeros(len(whole) + 1, bool)
        first[upto] = True
        starts = np.flatnonzero(_PLAIN[whole] | first[:-1])
        numbers, units = wordlists.numbered(whole, np.append(starts, len(whole)))
        ids, begins, stops = self._of(units)
        got, places = wordlists.slices(ids, begins[numbers], stops[numbers])
        if not odd.any():
            return got, places[np.searchsorted(starts, ends)] if len(starts) else np.zeros(len(ends), np.int64)
        rows = np.split(got, places[np.searchsorted(starts, upto[1:-1])]) if len(upto) > 1 else []
        rows, out = iter(rows), []
        for i, o in enumerate(odd.tolist()):
            out.append(np.array(self._ids(_text(data, ends, i)), self.dtype) if o else next(rows))
        return np.concatenate(out), np.concatenate([[0], np.cumsum([len(x) for x in out])])


_ENCODERS: dict[str, Encoder] = {}
common.KEPT["encoders"] = _ENCODERS


def encoder(path: str) -> Encoder:
    """One encoder per file and worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def little(ids: np.ndarray) -> np.ndarray:
    """Ids as little-endian unsigned 32-bit integers."""
    return ids.astype("<u4")


def ended(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts as little-endian unsigned 32-bit integers with an end id after each text, and the n+1 ends."""
    return np.insert(little(ids), ends[1:], end_id), ends + np.arange(len(ends))
