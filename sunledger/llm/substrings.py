"""Operator 11: words of repeated passages, found by dealing out windows of words as super-k-mers.

A window is ``WIDTH`` consecutive words of one document.  Its minimiser is the least hash among its runs of ``SEED`` words.
Consecutive windows of a document that share their minimiser travel as one packed string, a super-k-mer, to the bucket that
the minimiser names; so equal windows always meet, and a word is sent about three times instead of ``WIDTH`` times.  There
the strings are opened, windows sorted, equal neighbours compared word by word, and counted.

Texts lie in blocks of some megabytes.  A block sends each distinct super-k-mer once, with its least ``doc_id`` and how often
the block has it, so that thousands of copies cost a row a block; it gets back a bit for each window, whether a smaller
``doc_id`` has it.  A bucket that the loads of all blocks show to be too large (one common run of words in many different
surroundings) is split: its windows travel alone, to buckets that the whole window names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.llm import common, wordlists
from sunledger.llm.blocks import Blocks, total_bytes

WIDTH = 13
#: Words of the runs whose least hash is the minimiser.
SEED = 3
BLOCK_BYTES = 6 << 20
#: Words that a bucket should get, and times of it from which a bucket is split.
BUCKET_WORDS, SPLIT = 1 << 20, 4
#: Windows of a super-k-mer at most, in runs of one word.
LONGEST = 256
#: Words that numpy temporaries are made for at once.
_STEP = 1 << 18

_SENT = "bucket long, block long, n int, docs binary, times binary, words binary"
_NEWLINE = 0x0A


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, by start."""
    have = 1
    while 2 * have <= width:
        h, have = np.minimum(h[:-have], h[have:]), 2 * have
    return np.minimum(h[: len(h) - (width - have)], h[width - have :]) if have < width else h


def _runs(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every ``width`` neighbours, by start."""
    n = max(len(words) - width + 1, 0)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = common.mix(h + words[k : k + n] * np.uint64(0x9E3779B97F4A7C15 + 2 * k))
    return h


class Words:
    """Words of a block's texts, and its super-k-mers.  Rows without ``doc_id`` have no window."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, docs: np.ndarray, known: np.ndarray, width: int):
        self.width, self.docs, self.known = width, docs, known
        self.bytes, self.stops, self.rows = wordlists.spaced(data, ends)
        self.ids, distinct = wordlists.numbered(self.bytes, self.stops)
        raw, upto = wordlists.bytes_of(distinct)
        self.hashes = common.Prefix(raw).ranges(upto[:-1], upto[1:])
        self.row = np.repeat(np.arange(len(docs)), np.diff(self.rows))

    def stretches(self, buckets: int, split: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window, number of windows and bucket of each super-k-mer, in order of the text."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for lo in range(0, len(self.ids) - self.width + 1, _STEP):
            h = self.hashes[self.ids[lo : lo + _STEP + self.width - 1]]
            seed = min(SEED, self.width)
            least = _least(_runs(h, seed), self.width - seed + 1)
            at = np.arange(lo, lo + len(least))
            row = self.row[at]
            whole = (at + self.width <= self.rows[1:][row]) & self.known[row]
            at, row, least = at[whole], row[whole], least[whole]
            if not len(at):
                continue
            new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1]) | (least[1:] != least[:-1])])
            first = np.flatnonzero(new)
            new[np.arange(len(at)) - first[np.cumsum(new) - 1] & (LONGEST - 1) == 0] = True
            bucket = (common.mix(least ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int64)
            if split:
                apart = np.isin(bucket, np.fromiter(split, np.int64))
                alone = _runs(h, self.width)[at[apart] - lo]
                parts = np.array([split[b] for b in bucket[apart].tolist()], np.uint64)
                bucket[apart] += buckets * (1 + (alone % parts).astype(np.int64)) if len(alone) else 0
                new |= apart
                new[1:] |= apart[:-1]
            first = np.flatnonzero(new)
            found.append((at[first], np.diff(first, append=len(at)), bucket[first]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def strings(self, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, pa.LargeBinaryArray]:
        """Numbers of the super-k-mers and the distinct ones by number, equal byte by byte; each ends with a line end."""
        if not len(first):
            return np.zeros(0, np.int64), pa.array([], pa.large_binary())
        lo, start, stop, chunk = 0, self.stops[first], self.stops[first + count + self.width - 1], []
        upto = np.cumsum(stop - start)
        while lo < len(first):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + (4 << 20), "right")))
            raw, ends = wordlists.slices(self.bytes, start[lo:hi], stop[lo:hi])
            raw[ends[1:] - 1] = _NEWLINE
            chunk.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(ends), pa.py_buffer(raw)]))
            lo = hi
        coded = pa.chunked_array(chunk, pa.large_binary()).dictionary_encode().unify_dictionaries()
        numbers = np.concatenate([np.asarray(x.indices) for x in coded.chunks])
        return numbers, coded.chunk(0).dictionary

    def load(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and the words that this block sends them, copies once (told by hashes, as only the load depends on it)."""
        first, count, bucket = self.stretches(buckets, {})
        h = self.hashes[self.ids]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(common.mix(h))])
        key = common.mix((sums[first + count + self.width - 1] - sums[first]) ^ common.mix(h[first] + np.uint64(1)) ^ count.astype(np.uint64))
        _, one = np.unique(key, return_index=True)
        keys, back = np.unique(bucket[one], return_inverse=True)
        return keys, np.bincount(back, count[one] + self.width - 1, len(keys)).astype(np.int64)


class Sent:
    """What a block sends: its distinct super-k-mers in bucket order, with the least ``doc_id`` and the number of places."""

    def __init__(self, words: Words, buckets: int, split: dict[int, int]):
        self.first, self.count, bucket = words.stretches(buckets, split)
        number, self.distinct = words.strings(self.first, self.count)
        n = len(self.distinct)
        self.doc = words.docs[words.row[self.first]]
        where, size = np.zeros(n, np.int64), np.zeros(n, np.int64)
        where[number], size[number] = bucket, self.count
        self.order = np.argsort(where, kind="stable")
        rank = np.empty(n, np.int64)
        rank[self.order] = np.arange(n)
        self.mine = rank[number]
        self.buckets, self.size = where[self.order], size[self.order]
        self.least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.mine, self.doc)
        self.times = np.bincount(self.mine, minlength=n).astype("<u4")

    def rows(self, block: int) -> Iterator[tuple]:
        edges = np.flatnonzero(np.diff(self.buckets, prepend=-1, append=-1)) if len(self.buckets) else []
        raw, upto = wordlists.bytes_of(self.distinct)
        starts, stops = upto[:-1][self.order], upto[1:][self.order]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            packed, _ = wordlists.slices(raw, starts[lo:hi], stops[lo:hi])
            yield int(self.buckets[lo]), block, len(packed), self.least[lo:hi].astype("<i8").tobytes(), self.times[lo:hi].tobytes(), pa.compress(packed.tobytes(), "zstd", asbytes=True)

    def repeated(self, words: Words, answers: list[dict]) -> np.ndarray:
        """Starts of windows that a smaller ``doc_id`` has too."""
        bits = [np.unpackbits(np.frombuffer(a["earlier"], np.uint8), count=a["n"]) for a in sorted(answers, key=lambda a: a["bucket"])]
        bits = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
        begins = np.cumsum(self.size) - self.size
        nth = np.arange(self.count.sum()) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        earlier = bits[np.repeat(begins[self.mine], self.count) + nth]
        later = np.repeat(self.doc > self.least[self.mine], self.count)
        return (np.repeat(self.first, self.count) + nth)[earlier | later]


class Opened:
    """Super-k-mers of a bucket: their windows in the order sent, and a number for each that equal windows share."""

    def __init__(self, table: pa.Table, width: int):
        raw = [np.frombuffer(pa.decompress(w.as_py(), n.as_py(), "zstd", asbytes=True), np.uint8) for w, n in zip(table.column("words"), table.column("n"), strict=True)]
        data = np.concatenate(raw)
        line = data == _NEWLINE
        ends = np.flatnonzero(line | (data == 0x20)) + 1
        last = np.flatnonzero(line[ends - 1])
        data = np.where(line, np.uint8(0x20), data)
        self.stops = np.concatenate([[0], ends])
        self.ids, self.distinct = wordlists.numbered(data, self.stops)
        begins = np.concatenate([[0], last[:-1] + 1])
        self.count = last - begins + 2 - width
        self.windows = np.arange(self.count.sum()) + np.repeat(begins - np.cumsum(self.count) + self.count, self.count)
        strings = [len(x.as_py()) // 8 for x in table.column("docs")]
        upto = np.concatenate([[0], np.cumsum(self.count)])
        self.edges = upto[np.concatenate([[0], np.cumsum(strings)])]
        doc = np.frombuffer(b"".join(x.as_py() for x in table.column("docs")), "<i8")
        times = np.frombuffer(b"".join(x.as_py() for x in table.column("times")), "<u4")
        self.doc, self.times = np.repeat(doc, self.count), np.repeat(times, self.count)
        self.width = width

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """Order that puts equal windows side by side, and the start of each group in it."""
        h = common.mix(self.ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        h = _runs(h, self.width)[self.windows]
        order = np.argsort(h, kind="stable")
        same = h[order[1:]] == h[order[:-1]]
        a, b = self.windows[order[:-1][same]], self.windows[order[1:][same]]
        if not all(np.array_equal(self.ids[a + k], self.ids[b + k]) for k in range(self.width)):  # two windows of one hash
            names = np.unique(self.ids[self.windows[:, None] + np.arange(self.width)], axis=0, return_inverse=True)[1].ravel()
            order = np.argsort(names, kind="stable")
            same = names[order[1:]] == names[order[:-1]]
        return order, np.flatnonzero(np.concatenate([[True], ~same]))

    def least(self) -> np.ndarray:
        """The least ``doc_id`` that has the window, for each."""
        order, starts = self.sorted()
        out = np.empty(len(order), np.int64)
        out[order] = np.repeat(np.minimum.reduceat(self.doc[order], starts), np.diff(starts, append=len(order)))
        return out


def _answered(width: int):
    def run(table: pa.Table) -> pa.Table:
        opened = Opened(table, width)
        earlier = opened.least() < opened.doc
        bits = [np.packbits(earlier[a:b]).tobytes() for a, b in zip(opened.edges[:-1], opened.edges[1:], strict=True)]
        columns = {"block": table.column("block"), "bucket": table.column("bucket"), "n": pa.array(np.diff(opened.edges), pa.int32())}
        return pa.table(columns | {"earlier": pa.array(bits, pa.binary())})

    return run


def _counted(width: int, at_least: int):
    def run(table: pa.Table) -> pa.Table:
        opened = Opened(table, width)
        order, starts = opened.sorted()
        times = np.add.reduceat(opened.times[order].astype(np.int64), starts)
        first = np.minimum.reduceat(opened.doc[order], starts)
        often = times >= at_least
        at = opened.windows[order[starts[often]]]
        words = [b" ".join(x.as_py()[:-1] for x in opened.distinct.take(pa.array(opened.ids[i : i + width]))).decode() for i in at.tolist()]
        return pa.table({"words": pa.array(words, pa.string()), "times": pa.array(times[often]), "first_doc": pa.array(first[often])})

    return run


def _words(row: pa.RecordBatch, width: int) -> Words:
    data, ends = np.frombuffer(row.column("data")[0].as_buffer(), np.uint8), np.asarray(row.column("ends")[0].values)
    docs = row.column("rows").flatten().field("c0").cast(pa.int64())
    return Words(data, ends, docs.fill_null(0).to_numpy(), docs.is_valid().to_numpy(zero_copy_only=False), width)


class Windows:
    """Blocks of all texts, their super-k-mers dealt out; ``answers`` says which windows stand in earlier documents."""

    def __init__(self, docs: DataFrame, width: int = WIDTH):
        self.stage, self.width = common.Stage(docs.sparkSession), width
        rest = [c for c in docs.columns if c not in ("doc_id", "text")]
        self.made = Blocks(docs.select("doc_id", "text", *[F.col(f"`{c}`") for c in rest]), self.stage, BLOCK_BYTES)
        words = total_bytes(self.made.frame) // 2
        self.buckets = max(4 * self.made.n, words // BUCKET_WORDS)
        self.split = self._split()

    def _split(self) -> dict[int, int]:
        """Buckets that would get more than ``SPLIT`` times their share, and the number of parts for each.

        There are fewer of them than a ``SPLIT``-th of the buckets that the size of the input gives.
        """
        width, buckets = self.width, self.buckets

        def loads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            common.forget()
            for batch in batches:
                for i in range(batch.num_rows):
                    keys, load = _words(batch.slice(i, 1), width).load(buckets)
                    yield common.batch_of({"bucket": keys, "load": load})

        found = self.made.frame.select("ends", "data", "rows").mapInArrow(loads, "bucket long, load long")
        large = found.groupBy("bucket").agg(F.sum("load").alias("load")).where(F.col("load") > SPLIT * BUCKET_WORDS)
        return {r["bucket"]: -(-r["load"] * width // (2 * BUCKET_WORDS)) for r in large.collect()}

    def sent(self) -> DataFrame:
        buckets, split, width = self.buckets, self.split, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            common.forget()
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1)
                    rows = list(Sent(_words(row, width), buckets, split).rows(row.column("block")[0].as_py()))
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                    columns = list(zip(*rows, strict=True)) or [[]] * 6
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["bucket", "block", "n", "docs", "times", "words"])

        return self.made.frame.select("block", "ends", "data", "rows").mapInArrow(run, _SENT)

    def counts(self, at_least: int) -> DataFrame:
        return self.sent().groupBy("bucket").applyInArrow(_counted(self.width, at_least), "words string, times long, first_doc long")

    def map(self, func, schema: T.StructType | str) -> DataFrame:
        """``func(rows, words, covered)`` makes a record batch of each block; ``covered`` tells its removed words."""
        buckets, split, width = self.buckets, self.split, self.width
        got = self.sent().groupBy("bucket").applyInArrow(_answered(width), "block long, bucket long, n int, earlier binary")
        got = self.stage.save(got, "answers").groupBy("block").agg(F.collect_list(F.struct("bucket", "n", "earlier")).alias("answers"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            common.forget()
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1)
                    words = _words(row, width)
                    starts = Sent(words, buckets, split).repeated(words, row.column("answers")[0].as_py() or [])
                    steps = np.zeros(len(words.ids) + 1, np.int32)
                    steps[starts] = 1  # a start comes once, and so does a stop
                    steps[starts + width] -= 1
                    yield func(row.column("rows").flatten(), words, np.cumsum(steps[:-1]) > 0)

        return self.made.met(got, "rows").mapInArrow(run, schema)



def _kept(words: Words, covered: np.ndarray) -> list[bytes]:
    """The kept words of each row, joined by one blank."""
    sizes = np.diff(words.stops)
    raw = words.bytes[np.repeat(~covered, sizes)].tobytes()
    upto = np.concatenate([[0], np.cumsum(np.where(covered, 0, sizes))])[words.rows].tolist()
    return [raw[a : max(a, b - 1)] for a, b in zip(upto[:-1], upto[1:], strict=True)]


def _digested(rows: pa.StructArray, words: Words, covered: np.ndarray) -> pa.RecordBatch:
    upto = np.concatenate([[0], np.cumsum(covered)])[words.rows]
    sha = [hashlib.sha256(x).hexdigest() for x in _kept(words, covered)]
    return common.batch_of({"doc_id": rows.field("c0"), "n_words": np.diff(words.rows), "n_removed": np.diff(upto), "kept_sha256": pa.array(sha, pa.string())})


def removals(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row.

    A word goes if a window of ``width`` words covers it whose word sequence also starts in a document of a smaller
    ``doc_id``.  A null text has no words; texts of fewer than ``width`` words lose nothing.  Rows of equal ``doc_id`` never
    take words from one another; a null ``doc_id`` is not comparable, so its row neither loses words nor takes any.  Texts
    may be of any length (a long one is a block of its own); an empty table gives no row; other columns are not read.
    """
    return Windows(common.keyed(docs, "doc_id", "text"), width).map(_digested, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the kept words of ``text`` joined by one blank; null texts stay null, all other columns stay as they are.

    Nulls, equal ids and empty tables as in ``removals``.
    """
    order = docs.columns
    rest = ["doc_id", *[c for c in order if c not in ("doc_id", "text")]]

    def cut(rows: pa.StructArray, words: Words, covered: np.ndarray) -> pa.RecordBatch:
        texts = [None if gone else x.decode() for x, gone in zip(_kept(words, covered), rows.field("absent").to_pylist(), strict=True)]
        columns = {c: rows.field(f"c{i}") for i, c in enumerate(rest)} | {"text": pa.array(texts, pa.string())}
        return common.batch_of({c: columns[c] for c in order})

    return Windows(docs, width).map(cut, docs.schema)


def windows(docs: DataFrame, width: int = WIDTH, at_least: int = 2) -> DataFrame:
    """``words, times, first_doc``: each distinct window that stands at ``at_least`` places, their number, the least ``doc_id``.

    Rows without ``doc_id`` have no windows; each place of a repeated row counts.
    """
    return Windows(common.keyed(docs, "doc_id", "text"), width).counts(at_least)
