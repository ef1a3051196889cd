"""Operator 8: benchmark decontamination with a distributed positional inverted index.

The index is split by documents: a shard holds the words of some whole documents as sorted distinct terms (64-bit hashes)
and, for each, the ascending positions where it stands.  Phrases never cross documents, so every shard answers alone; the
phrases, in blocks of bounded size, go to all shards.  A phrase starts from its rarest term there, and its candidates are
intersected with the lists of the other terms, rarest first, adjusted by their offsets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm import common

WINDOW = 10
SHARD_WORDS = 1 << 20
#: Windows of a block; 90 bytes each go to every executor at once.
BLOCK_WINDOWS = 200_000
_CANDIDATES = 1 << 20

#: A word is a run of digits, letters a to z and everything beyond ASCII.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[:0x30] = SEPARATOR[0x3A:0x61] = SEPARATOR[0x7B:0x80] = True

_INDEX = "shard long, doc_ids array<long>, text_hashes array<long>, ends array<long>, terms binary, counts binary, positions binary"


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId() << 32
    docs, hashes, words, sizes, held = [], [], [], [], 0

    def out():
        h = np.concatenate(words)
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(np.diff(h[order], prepend=h[order[:1]] + np.uint64(1))) if len(h) else np.zeros(0, np.int64)
        counts = np.diff(first, append=len(h))
        ends = np.cumsum(np.concatenate([[0], *sizes]))
        values = [[shard], [np.concatenate(docs).tolist()], [np.concatenate(hashes)], [ends], [h[order][first].tobytes()], [counts.astype("<u4").tobytes()], [order.astype("<u4").tobytes()]]
        long, longs, raw = pa.int64(), pa.list_(pa.int64()), pa.binary()
        names = ["shard", "doc_ids", "text_hashes", "ends", "terms", "counts", "positions"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, (long, longs, longs, longs, raw, raw, raw), strict=True)], names=names)

    for some, data, ends in common.chunks(batches):
        docs.append(np.array(some.column("doc_id").to_pylist(), object))
        hashes.append(some.column("text_hash").to_numpy())
        h, rows = common.hashed_words(data, ends, _LOWERED)
        words.append(h)
        sizes.append(np.diff(rows))
        held += len(h)
        if held >= SHARD_WORDS:
            yield out()
            docs, hashes, words, sizes, held, shard = [], [], [], [], 0, shard + 1
    if docs:
        yield out()


#: Separators of the text as it comes, where A-Z still stand.
_LOWERED = SEPARATOR.copy()
_LOWERED[0x41:0x5B] = False


def build_index(docs: DataFrame) -> DataFrame:
    """Index shards over the whole texts of all rows; a null text has no words.  Rows may share a ``doc_id`` or have none."""
    common.shipped(docs.sparkSession)
    return common.keyed(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text")).mapInArrow(_indexed, _INDEX)


@dataclass
class Phrases:
    """Distinct windows as rows of ``WINDOW`` word hashes with lengths, and the items they come from."""

    words: np.ndarray
    lengths: np.ndarray
    window: np.ndarray
    item: np.ndarray
    items: list[str]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some, data, ends in common.chunks(batches):
        h, rows = common.hashed_words(data, ends, _LOWERED)
        counts = np.diff(rows)
        n = np.where(counts == 0, 0, np.maximum(counts - WINDOW + 1, 1))
        row = np.repeat(np.arange(len(counts)), n)
        start = rows[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        length = np.minimum(counts[row], WINDOW)
        padded = np.concatenate([h, np.zeros(WINDOW, np.uint64)])
        words = np.where(np.arange(WINDOW) < length[:, None], padded[start[:, None] + np.arange(WINDOW)], 0).astype("<u8")
        yield common.batch_of({"item_id": some.column("item_id").take(pa.array(row)), "words": pa.array([w.tobytes() for w in words], pa.binary()), "length": length})


def phrase_blocks(benchmark: DataFrame) -> Iterator[Phrases]:
    """The windows of all items, in blocks of bounded size; a null item id reads ``null``."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
    rows = items.mapInArrow(_windows, "item_id string, words binary, length long").distinct()
    held: list = []
    for row in rows.toLocalIterator(prefetchPartitions=True):
        held.append(row)
        if len(held) >= BLOCK_WINDOWS:
            yield _block(held)
            held = []
    yield _block(held)


def _block(rows: list) -> Phrases:
    words, back = np.unique(np.frombuffer(b"".join(bytes(r["words"]) for r in rows), "<u8").reshape(-1, WINDOW), axis=0, return_inverse=True)
    lengths = np.zeros(len(words), np.int64)
    lengths[back] = [r["length"] for r in rows]
    items = sorted({r["item_id"] for r in rows})
    number = {x: i for i, x in enumerate(items)}
    return Phrases(words, lengths, np.asarray(back, np.int64).ravel(), np.array([number[r["item_id"]] for r in rows], np.int64), items)


class Shard:
    """One shard in memory: postings as sorted (term, position) pairs."""

    def __init__(self, row: dict):
        self.terms = np.frombuffer(row["terms"], "<u8")
        self.counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.positions = np.frombuffer(row["positions"], "<u4").astype(np.int64)
        self.keys = np.repeat(np.arange(len(self.terms), dtype=np.int64) << 32, self.counts) | self.positions
        self.ends = np.array(row["ends"], np.int64)

    def plan(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows all of whose terms stand here, their terms and the offsets of these, rarest first."""
        if not len(self.terms) or not len(phrases.words):
            none = np.zeros(0, np.int64)
            return none, np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64)
        at = np.minimum(np.searchsorted(self.terms, phrases.words), len(self.terms) - 1)
        used = np.arange(WINDOW) < phrases.lengths[:, None]
        there = ((self.terms[at] == phrases.words) | ~used).all(1)
        windows, at, used = np.flatnonzero(there), at[there], used[there]
        order = np.argsort(np.where(used, self.counts[at], np.iinfo(np.int64).max), axis=1, kind="stable")
        return windows, np.take_along_axis(at, order, 1), order

    def anchors(self, term: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of ``term`` with each of its positions, some at a time."""
        n = self.counts[term]
        upto = np.cumsum(n)
        lo = 0
        while lo < len(term):
            base = upto[lo] - n[lo]
            hi = max(lo + 1, int(np.searchsorted(upto, base + _CANDIDATES, "right")))
            row = np.repeat(np.arange(lo, hi), n[lo:hi])
            nth = np.arange(len(row)) - np.repeat(upto[lo:hi] - n[lo:hi] - base, n[lo:hi])
            yield row, self.positions[self.first[term[row]] + nth]
            lo = hi

    def exact(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """Windows and the positions where they start."""
        windows, term, offset = self.plan(phrases)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for row, position in self.anchors(term[:, 0]):
            start = position - offset[row, 0]
            length = phrases.lengths[windows[row]]
            doc = np.searchsorted(self.ends, position, "right") - 1
            ok = (start >= self.ends[doc]) & (start + length <= self.ends[doc + 1])
            row, start, length = row[ok], start[ok], length[ok]
            for j in range(1, WINDOW):
                key = term[row, j] << 32 | (start + offset[row, j])
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                ok = (self.keys[place] == key) | (j >= length)
                row, start, length = row[ok], start[ok], length[ok]
            found.append((windows[row], start))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def near(self, phrases: Phrases, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows and the positions of their rarest word where all their words stand within length + slop words of it."""
        windows, term, _ = self.plan(phrases)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for row, position in self.anchors(term[:, 0]):
            length = phrases.lengths[windows[row]]
            doc = np.searchsorted(self.ends, position, "right") - 1
            low = np.maximum(self.ends[doc], position - length - slop + 1)
            high = np.minimum(self.ends[doc + 1] - 1, position + length + slop - 1)
            ok = np.ones(len(row), bool)
            for j in range(1, WINDOW):
                place = np.minimum(np.searchsorted(self.keys, term[row, j] << 32 | low), len(self.keys) - 1)
                ok &= (self.keys[place] <= (term[row, j] << 32 | high)) & (self.keys[place] >> 32 == term[row, j]) | (j >= length)
            found.append((windows[row[ok]], position[ok]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching spans."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order]) if len(stop) else stop
    first = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]])) if len(start) else np.zeros(0, np.int64)
    return start[first], reach[np.append(first[1:], len(start)) - 1] if len(start) else stop


_FOUND = "shard long, row int, doc_id long, text_hash long, n_words long, starts array<long>, stops array<long>, items array<string>, near_items array<string>"


def _searched(block, slop: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases: Phrases = block.value
        by_window = np.argsort(phrases.window, kind="stable")
        upto = np.searchsorted(phrases.window[by_window], np.arange(len(phrases.words) + 1))

        def items_of(windows: np.ndarray) -> list[str]:
            mine = [phrases.item[by_window[upto[w] : upto[w + 1]]] for w in np.unique(windows).tolist()]
            return [phrases.items[i] for i in np.unique(np.concatenate(mine)).tolist()] if mine else []

        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                n = len(row["doc_ids"])
                window, start = shard.exact(phrases)
                doc = np.searchsorted(shard.ends, start, "right") - 1
                near, at = shard.near(phrases, slop) if slop is not None else (window[:0], start[:0])
                near_doc = np.searchsorted(shard.ends, at, "right") - 1
                starts, stops, items, near_items = ([[] for _ in range(n)] for _ in range(4))
                for d in np.unique(doc).tolist():
                    mine = doc == d
                    a, b = _merged(start[mine], start[mine] + phrases.lengths[window[mine]])
                    starts[d], stops[d] = (a - shard.ends[d]).tolist(), (b - shard.ends[d]).tolist()
                    items[d] = items_of(window[mine])
                for d in np.unique(near_doc).tolist():
                    near_items[d] = items_of(near[near_doc == d])
                texts = pa.list_(pa.string())
                yield common.batch_of({
                    "shard": np.full(n, row["shard"]), "row": pa.array(range(n), pa.int32()), "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "text_hash": pa.array(row["text_hashes"], pa.int64()), "n_words": np.diff(shard.ends), "starts": pa.array(starts, pa.list_(pa.int64())),
                    "stops": pa.array(stops, pa.list_(pa.int64())), "items": pa.array(items, texts), "near_items": pa.array(near_items, texts),
                })

    return run


def search(index: DataFrame, benchmark: DataFrame, slop: int | None = None) -> DataFrame:
    """One row per indexed document: the word spans (``starts``, ``stops``) that windows of the benchmark cover, and the ids
    of their items; with ``slop`` also ``near_items``, whose window's words all stand within that many more words than the
    window has around its rarest one.

    An item without words has no window.  An empty benchmark finds nothing.
    """
    spark = index.sparkSession
    parts = [index.mapInArrow(_searched(spark.sparkContext.broadcast(b), slop), _FOUND) for b in phrase_blocks(benchmark)]
    if len(parts) == 1:
        return parts[0]
    joined = [F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "stops", "items", "near_items")]
    firsts = [F.first(c).alias(c) for c in ("doc_id", "text_hash", "n_words")]
    return reduce(DataFrame.unionByName, parts).groupBy("shard", "row").agg(*firsts, *joined)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hit, items = [], [sorted(set(x)) for x in batch.column("items").to_pylist()]
        for a, b in zip(batch.column("starts").to_pylist(), batch.column("stops").to_pylist(), strict=True):
            a, b = _merged(np.array(a, np.int64), np.array(b, np.int64))
            hit.append(int((b - a).sum()))
        same = {c: batch.column(c) for c in ("doc_id", "text_hash", "n_words")}
        sha = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
        yield common.batch_of(same | {"n_hit": pa.array(hit, pa.int64()), "n_items": pa.array([len(x) for x in items], pa.int64()), "items_sha256": pa.array(sha, pa.string())})


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated`` from the spans and items of a search."""
    out = found.mapInArrow(_digested, "doc_id long, text_hash long, n_words long, n_hit long, n_items long, items_sha256 string")
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Index all documents, search all windows of the benchmark, one row for each document."""
    stage = common.Stage(docs.sparkSession)
    return digest(search(stage.save(build_index(docs), "index", "snappy"), benchmark))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that no window of the benchmark hits, with all their columns."""
    hit = contamination(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text")).distinct()
    return docs.join(hit, hit["_id"].eqNullSafe(docs["doc_id"]) & (hit["_text"] == F.xxhash64(docs["text"])), "left_anti")
