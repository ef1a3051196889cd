"""Operator 4: context-triggered piecewise hashes of texts, and their likeness.

A rolling hash of the last ``WINDOW`` bytes cuts a text where it is -1 modulo the block size; each chunk gives one
character.  The block size is ``3 * 2**k``, so cuts of a size are also cuts of all smaller ones.  A fingerprint is
``size:signature:signature at twice the size``; two are compared at a size they have in common, by edit distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm import common

WINDOW, LEAST_BLOCK = 7, 3
#: Characters of a signature at most, and those below which the block size is halved.
LONG, ENOUGH = 64, 32
#: Equal characters in a row that two signatures need (or all of the shorter one) to be alike at all.
RUN = 7
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_NONE = 64


@dataclass
class Fingerprints:
    """Block size exponents, and signatures as rows of codes (``_NONE`` behind the end) with lengths."""

    k: np.ndarray
    sig: tuple[np.ndarray, np.ndarray]
    size: tuple[np.ndarray, np.ndarray]

    def text(self) -> list[str]:
        chars = np.append(_ALPHABET, 0)
        rows = [[r.tobytes()[:n].decode() for r, n in zip(chars[s].astype(np.uint8), m.tolist(), strict=True)] for s, m in zip(self.sig, self.size, strict=True)]
        return [f"{LEAST_BLOCK << k}:{a}:{b}" for k, a, b in zip(self.k.tolist(), *rows, strict=True)]

    def take(self, at: np.ndarray) -> Fingerprints:
        return Fingerprints(self.k[at], tuple(s[at] for s in self.sig), tuple(m[at] for m in self.size))


def _signatures(prefix: common.Prefix, ends: np.ndarray, cut: np.ndarray, row: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the chunks of each row: up to each cut, the last chunk up to the row's end; ``most`` at most."""
    n = len(ends) - 1
    nth = np.arange(len(cut)) - np.searchsorted(row, np.arange(n))[row]
    inner = nth < most - 1
    cut, row, nth = cut[inner], row[inner], nth[inner]
    got = np.bincount(row, minlength=n)
    stops = np.zeros((n, most + 1), np.int64)
    stops[:, 0] = ends[:-1]
    stops[row, nth + 1] = cut
    last = stops[np.arange(n), got] < ends[1:]
    size = got + last
    stops[np.flatnonzero(last), got[last] + 1] = ends[1:][last]
    codes = np.full((n, most), _NONE, np.uint8)
    i, j = np.nonzero(np.arange(most)[None, :] < size[:, None])
    codes[i, j] = prefix.ranges(stops[i, j], stops[i, j + 1]) & np.uint64(63)
    return codes, size


def fingerprints(data: np.ndarray, ends: np.ndarray) -> Fingerprints:
    """Of rows of bytes.  A row without bytes has the least block size and empty signatures."""
    n, length = len(ends) - 1, np.diff(ends)
    prefix = common.Prefix(data)
    start = np.maximum(np.arange(len(data)) + 1 - WINDOW, np.repeat(ends[:-1], length))
    rolling = prefix.ranges(start, np.arange(1, len(data) + 1)) >> np.uint64(20)
    at = np.flatnonzero((rolling + np.uint64(1)) % np.uint64(LEAST_BLOCK) == 0)
    value = rolling[at] + np.uint64(1)
    level = np.bitwise_count((value & (~value + np.uint64(1))) - np.uint64(1)).astype(np.int64)
    row = np.searchsorted(ends, at, "right") - 1
    top = np.maximum(0, np.ceil(np.log2(np.maximum(length, 1) / (LEAST_BLOCK * LONG)))).astype(np.int64)
    levels = int(top.max(initial=0)) + 2
    counts = np.zeros((n, levels), np.int64)
    np.add.at(counts, (row, np.minimum(level, levels - 1)), 1)
    counts = counts[:, ::-1].cumsum(1)[:, ::-1]
    fits = (counts >= ENOUGH) & (np.arange(levels)[None, :] <= top[:, None])
    k = np.where(fits.any(1), levels - 1 - fits[:, ::-1].argmax(1), 0)
    sides = []
    for more, most in ((0, LONG), (1, LONG // 2)):
        mine = level >= k[row] + more
        sides.append(_signatures(prefix, ends, at[mine] + 1, row[mine], most))
    return Fingerprints(k, *zip(*sides, strict=True))


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def _alike(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    """1 - insertions and deletions between signatures over their summed length; 0 without a common run."""
    out = np.zeros(len(a))
    need = np.minimum(RUN, np.minimum(n, m))
    common_run = np.zeros(len(a), bool)
    for r in np.unique(need[need > 0]).tolist():
        mine = np.flatnonzero(need == r)
        grams = []
        for s, size in ((a[mine], n[mine]), (b[mine], m[mine])):
            g = np.zeros((len(mine), s.shape[1] - r + 1), np.int64)
            for j in range(r):
                g = g << 7 | s[:, j : j + g.shape[1]]
            grams.append((g, np.arange(g.shape[1])[None, :] <= (size - r)[:, None]))
        (x, fx), (y, fy) = grams
        common_run[mine] = ((np.where(fx, x, -1)[:, :, None] == np.where(fy, y, -2)[:, None, :]).any((1, 2)))
    some = np.flatnonzero(common_run)
    if len(some):
        a, b, n, m = a[some], b[some], n[some], m[some]
        places = np.zeros((len(some), _NONE + 1), np.uint64)
        line = np.arange(len(some))
        for j in range(a.shape[1]):
            places[line, a[:, j]] |= np.where(j < n, np.uint64(1 << j), np.uint64(0))
        v = np.full(len(some), ~np.uint64(0))
        for j in range(b.shape[1]):  # longest common subsequence, 64 places at once
            u = v & np.where(j < m, places[line, b[:, j]], np.uint64(0))
            v = (v + u) | (v - u)
        kept = ~v & np.where(n >= 64, ~np.uint64(0), (np.uint64(1) << np.minimum(n, 63).astype(np.uint64)) - np.uint64(1))
        out[some] = 2 * np.bitwise_count(kept) / (n + m)
    return out


def likeness(x: Fingerprints, y: Fingerprints) -> np.ndarray:
    """0 to 1 for each pair of rows: 1 for equal fingerprints, 0 where no block size is common."""
    out = np.zeros(len(x.k))
    for i, j, mine in ((0, 0, x.k == y.k), (1, 1, x.k == y.k), (0, 1, x.k == y.k + 1), (1, 0, x.k + 1 == y.k)):
        at = np.flatnonzero(mine)
        for lo in range(0, len(at), 1000):
            some = at[lo : lo + 1000]
            out[some] = np.maximum(out[some], _alike(x.sig[i][some], x.size[i][some], y.sig[j][some], y.size[j][some]))
    same = (x.k == y.k) & (x.sig[0] == y.sig[0]).all(1) & (x.sig[1] == y.sig[1]).all(1)
    return np.where(same, 1.0, out)


def _compared(rows: list[tuple]) -> pa.RecordBatch | None:
    """Rows with a next one in the same bucket; a row is ``(bucket, carried, doc_id, text)``."""
    own = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
    if not own:
        return None
    texts = [r[3] for r in rows]
    edited = []
    for i in own:
        half = len(texts[i]) // 2
        edited.append(texts[i][: len(texts[i]) - half] + texts[i + 1][:half])
    whole, changed, at = fingerprints(*_joined(texts)), fingerprints(*_joined(edited)), np.array(own)
    mine, printed = whole.take(at), whole.text()
    return common.batch_of({
        "doc_id": pa.array([rows[i][2] for i in own], pa.int64()),
        "n_chars": pa.array([len(texts[i]) for i in own], pa.int64()),
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": [printed[i] for i in own],
        "edited_fingerprint": changed.text(),
        "near_edited": likeness(mine, changed),
        "near_next": likeness(mine, whole.take(at + 1)),
    })


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for some, _, _ in common.chunks(batches, limit=common.CHUNK_BYTES // 2):
        for bucket, carried, doc, text in zip(*(some.column(c).to_pylist() for c in ("bucket", "carried", "doc_id", "text")), strict=True):
            held.append((bucket, carried, doc, text or ""))
            size += len(held[-1][3])
            if size > common.CHUNK_BYTES // 2 and len(held) > 1:
                if (out := _compared(held)) is not None:
                    yield out
                held = held[-1:]
                size = len(held[0][3])
    if (out := _compared(held)) is not None:
        yield out


_LEAST = -(1 << 63)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprint every text, compare it with that of its edited text and of the next document.

    The next document is the one behind in descending ``doc_id`` (null last; rows of equal ``doc_id`` in order of a hash of
    their text), after the last the first; the only document is its own next.  The edited text has the last half of the
    code points replaced by the first as many of the next document.  A null text is empty.  An empty table gives no rows.

    Documents go to buckets of neighbouring ids; the first rows of a bucket also go to the bucket before, as its end.
    """
    spark = common.shipped(docs.sparkSession)
    n = common.partitions(spark)
    rows = common.keyed(docs, "doc_id", "text").withColumn("k", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)))
    buckets = 4 * n
    marks = rows.agg(F.percentile_approx("k", [(i + 1) / buckets for i in range(buckets - 1)], 20 * buckets)).head()[0]
    marks = np.unique(np.array(marks or [], np.int64))

    @F.pandas_udf("int")
    def bucket_of(k: pd.Series) -> pd.Series:
        return pd.Series((len(marks) - np.searchsorted(marks, k.to_numpy(np.int64), "left")).astype(np.int32))

    # one number for each bucket
    firsts = rows.select("k", bucket_of("k").alias("b")).groupBy("b").agg(F.max("k").alias("k")).orderBy("b").collect()
    before = {r["k"]: firsts[i - 1]["b"] for i, r in enumerate(firsts)}
    keys = np.array(sorted(before), np.int64)
    target = np.array([before[k] for k in sorted(before)], np.int64)

    @F.pandas_udf("array<int>")
    def targets_of(k: pd.Series) -> pd.Series:
        k = k.to_numpy(np.int64)
        own = len(marks) - np.searchsorted(marks, k, "left")
        at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
        first = keys[at] == k
        return pd.Series([[o, -1 - t] if f else [o] for o, f, t in zip(own.tolist(), first.tolist(), target[at].tolist(), strict=True)])

    dealt = rows.select("doc_id", "text", "k", F.explode(targets_of("k")).alias("to")).withColumns({"carried": F.col("to") < 0, "bucket": F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to"))})
    dealt = dealt.repartition(n, "bucket").sortWithinPartitions("bucket", "carried", F.desc("k"), F.xxhash64("text"))
    out = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.select("bucket", "carried", "doc_id", "text").mapInArrow(_neighbours, out)
