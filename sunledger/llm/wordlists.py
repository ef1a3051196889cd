"""Words of a chunk of texts as one run of bytes with ends, and exact numbers for them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from sunledger.llm import common

_BLANK = 0x20


def spaced(data: np.ndarray, ends: np.ndarray, is_separator: np.ndarray = common.SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words, each followed by one blank; the n+1 ends of the words in them; the n+1 word ends of the rows."""
    joined = np.insert(data, ends[1:], _BLANK)
    apart = is_separator[joined]
    kept = ~apart
    kept[1:] |= kept[:-1].copy()
    words = np.where(apart, np.uint8(_BLANK), joined)[kept]
    stops = np.flatnonzero(apart[kept]) + 1
    upto = np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])[ends + np.arange(len(ends))]
    return words, np.concatenate([[0], stops]), np.searchsorted(stops, upto, "right")


def numbered(words: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """A number for each word, equal for equal bytes only, and the distinct words (with their blank) by number."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(stops, np.int64)), pa.py_buffer(words)]
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stops) - 1, buffers).dictionary_encode()
    return np.asarray(coded.indices), coded.dictionary


def slices(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte ranges one after the other, and their n+1 ends."""
    sizes = stops - starts
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return data[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)], ends


def bytes_of(values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 ends of a binary array."""
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, np.int64)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]
