"""Operator 2: interpolated modified Kneser-Ney bigram model, counted in Spark and read from sorted arrays.

Words get dense ids in buckets of their hashes.  A bigram lives in the bucket of its first word (the few words that a large
share of the tokens follows are spread over all buckets by both words), so a bucket holds whole contexts: its part of the
model is a sorted array of bigram keys with counts, and one of contexts with their totals.  The parts are a table bucketed
by that number.  To score, a block of texts sends each distinct bigram once to its bucket, where a worker memory-maps the
part and answers by binary search; the block adds the answers up for its documents.

    p(w | v) = max(c(v w) - D(c), 0) / c(v .) + g(v) p(w)
    p(w) = max(n(. w) - D'(n), 0) / n(. .) + g' / (V + 1)

n(. w) counts the distinct words before w, and the discounts come from the counts of counts of either level.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm import common
from sunledger.llm.blocks import Blocks, bucketed, total_bytes

#: Bytes of text for each bucket.
BUCKET_BYTES = 16 << 20
#: A context with more than 1 / (HOT * buckets) of the training tokens is spread; so at most HOT * buckets are.
HOT = 4
#: Names of the end of a text, and ids of its start and of words that training has not.
_END = np.uint64(0x1F83D9ABFB41BD6B)
_WIDE = 1 << 32


def _buckets(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


class Words:
    """Tokens of a block (words of each row, then its end), as distinct names in ascending order and places in them."""

    def __init__(self, row: dict):
        self.block = row["block"]
        self.ends = np.array(row["ends"], np.int64)
        h, rows = common.hashed_words(np.frombuffer(row["data"], np.uint8), self.ends)
        n = len(self.ends) - 1
        self.rows = rows + np.arange(n + 1)
        tokens = np.empty(len(h) + n, np.uint64)
        last = np.zeros(len(tokens), bool)
        last[self.rows[1:] - 1] = True
        tokens[~last], tokens[last] = h, _END
        self.names, self.at = np.unique(tokens, return_inverse=True)
        self.row = np.repeat(np.arange(n), np.diff(self.rows))

    def training(self, held_out: np.ndarray) -> np.ndarray:
        return ~held_out[self.row]

    def bigrams(self, ids: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the word before (or of the start) and of each token."""
        w = ids[self.at]
        v = np.concatenate([[np.uint64(start)], w[:-1]])
        v[self.rows[:-1]] = start
        return v, w


def _held_out(row: dict) -> np.ndarray:
    return np.array([x["c1"] for x in row["rows"]], bool)


def _batch(rows: list[tuple], names: str, kinds: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names.split())


_I, _L, _B = pa.int32(), pa.int64(), pa.binary()


def _word_counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = Words(row)
                counts = np.bincount(words.at, words.training(_held_out(row)), len(words.names)).astype("<u4")
                edges = np.searchsorted(_buckets(words.names, buckets), np.arange(buckets + 1))
                parts = [(b, words.block, words.names[lo:hi].tobytes(), counts[lo:hi].tobytes()) for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if lo < hi]
                yield _batch(parts, "bucket block names counts", (_I, _L, _B, _B))

    return run


def _word_ids(table: pa.Table) -> pa.Table:
    """Of a bucket: to each block the rank and training count of its words; to the null block the bucket's counts by rank."""
    table = table.sort_by("block").combine_chunks()
    parts = [np.frombuffer(x.as_buffer(), "<u8") for x in table.column("names")]
    counts = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in table.column("counts")])
    names, rank = np.unique(np.concatenate(parts), return_inverse=True)
    whole = np.bincount(rank, counts, len(names)).astype("<i8")
    edges = np.cumsum([0, *map(len, parts)])
    bucket = table.column("bucket")[0].as_py()
    rows = [(b, bucket, len(p), rank[lo:hi].astype("<u4").tobytes(), _narrow(whole[rank[lo:hi]])) for b, p, lo, hi in zip(table.column("block").to_pylist(), parts, edges[:-1], edges[1:], strict=True)]
    rows.append((None, bucket, len(names), b"", whole.tobytes()))
    return pa.Table.from_batches([_batch(rows, "block bucket n ranks counts", (_L, _I, _L, _B, _B))])


def _narrow(x: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs."""
    most = int(x.max(initial=0))
    return x.astype("u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<i8").tobytes()


def _widened(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, ("u1", "u1", "<u2", "<u2", "<u4", "<u4", "<u4", "<u4", "<i8")[len(raw) // n]).astype(np.int64)


class Vocabulary:
    """Ids and counts of a block's words from the answers of the buckets."""

    def __init__(self, answers: list[dict], bases: np.ndarray):
        mine = sorted(answers, key=lambda a: a["bucket"])
        self.ids = np.concatenate([np.frombuffer(a["ranks"], "<u4").astype(np.uint64) + np.uint64(bases[a["bucket"]]) for a in mine])
        self.counts = np.concatenate([_widened(a["counts"], a["n"]) for a in mine])
        self.before = np.concatenate([_widened(a["before"], a["n"]) for a in mine]) if "before" in mine[0] else None


@dataclass
class Layout:
    """How bigrams go to buckets, and how they are keyed there."""

    buckets: int
    bases: np.ndarray
    hot: np.ndarray

    @property
    def start(self) -> int:
        return int(self.bases[-1])

    @property
    def wide(self) -> bool:
        return self.start >= _WIDE - 1

    def bucket(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        spread = np.isin(v, self.hot)
        return _buckets(common.mix(common.mix(v + np.uint64(1)) + np.where(spread, w + np.uint64(1), np.uint64(0))), self.buckets)

    def key(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Exact below 2**32 words, else a hash of 64 bits."""
        return common.mix(common.mix(v) + w) if self.wide else v << np.uint64(32) | w

    def sent(self, block: int, v: np.ndarray, w: np.ndarray, weight: np.ndarray | None) -> tuple[list[tuple], np.ndarray]:
        """A row of distinct bigrams for each bucket, and for each bigram its place in all of them."""
        _, first, back = np.unique(self.key(v, w), return_index=True, return_inverse=True)
        v, w = v[first], w[first]
        bucket = self.bucket(v, w)
        order = np.argsort(bucket.astype(np.uint16) if self.buckets < 1 << 16 else bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        v, w = v[order], w[order]
        counts = np.bincount(back, weight, len(order)).astype("<u4")[order] if weight is not None else None
        kind, rows = ("<u8" if self.wide else "<u4"), []
        for b, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if lo < hi:
                begins = np.flatnonzero(np.concatenate([[True], v[lo + 1 : hi] != v[lo : hi - 1]]))
                runs = np.diff(begins, append=hi - lo).astype("<u4")
                contexts = np.diff(v[lo:hi][begins], prepend=np.uint64(0)).astype(kind)  # they ascend
                rows.append((b, block, len(runs), _squeezed(contexts), _narrow(runs), _squeezed(w[lo:hi].astype(kind)), _narrow(counts[lo:hi]) if counts is not None else b""))
        return rows, place[back]

    def received(self, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words, how many bigrams each has, and last words."""
        kind = "<u8" if self.wide else "<u4"
        runs = _widened(row["runs"], row["contexts"])
        return np.cumsum(_opened(row["v"], len(runs), kind).astype(np.uint64)), runs, _opened(row["w"], int(runs.sum()), kind).astype(np.uint64)


def _squeezed(x: np.ndarray) -> bytes:
    """Numbers compressed byte plane by byte plane: the high ones of ids are much alike."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _opened(raw: bytes, n: int, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(raw, n * size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).ravel()


_BIGRAMS = "bucket int, block long, contexts int, v binary, runs binary, w binary, counts binary"
_BIGRAM_KINDS = (_I, _L, _I, _B, _B, _B, _B)


def _bigrams(layout: Layout, training: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = Words(row)
                v, w = words.bigrams(Vocabulary(row["answers"], layout.bases).ids, layout.start)
                if training:
                    mine = words.training(_held_out(row))
                    v, w = v[mine], w[mine]
                rows, _ = layout.sent(words.block, v, w, np.ones(len(v)) if training else None)
                yield _batch(rows, "bucket block contexts v runs w counts", _BIGRAM_KINDS)

    return run


def _levels(counts: np.ndarray) -> np.ndarray:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5]


def _part(layout: Layout):
    """A bucket's part of the model: sorted bigram keys with counts, sorted contexts with total and counts of counts."""

    def run(table: pa.Table) -> pa.Table:
        got = []
        for row in table.to_pylist():
            v, runs, w = layout.received(row)
            got.append((np.repeat(v, runs), w, _widened(row["counts"], len(w))))
        v, w, c = (np.concatenate(x) for x in zip(*got, strict=True))
        keys, first, back = np.unique(layout.key(v, w), return_index=True, return_inverse=True)
        counts = np.bincount(back, c, len(keys)).astype(np.int64)
        contexts, of = np.unique(v[first], return_inverse=True)
        many = np.minimum(counts, 3)
        stats = np.stack([np.bincount(of, counts, len(contexts)), *[np.bincount(of[many == k], minlength=len(contexts)) for k in (1, 2, 3)]], 1)
        successors = w[first].tobytes() if layout.wide else b""
        one = (table.column("bucket")[0].as_py(), _squeezed(np.diff(keys, prepend=np.uint64(0))), counts.astype("<u4").tobytes(), contexts.tobytes(), stats.astype("<u4").tobytes(), _levels(counts).tolist(), successors)
        return pa.Table.from_batches([_batch([one], "bucket keys counts contexts stats levels successors", (_I, _B, _B, _B, _B, pa.list_(_L), _B))])

    return run


def _sorted_keys(part: dict) -> np.ndarray:
    """The keys of a part, which it holds as their differences."""
    n = len(part["counts"]) // 4
    return np.cumsum(_opened(part["keys"], n, "<u8"), dtype=np.uint64) if n else np.zeros(0, np.uint64)


_PARTS = "bucket int, keys binary, counts binary, contexts binary, stats binary, levels array<long>, successors binary"


def _lower_counts(layout: Layout):
    """From each part, the distinct words before each word, to the word's bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                # the last words of the bigrams, which narrow keys hold themselves
                w = np.frombuffer(row["successors"], "<u8") if layout.wide else _sorted_keys(row) & np.uint64(_WIDE - 1)
                ids, n = np.unique(w, return_counts=True)
                edges = np.searchsorted(ids, layout.bases.astype(np.uint64))
                parts = [(b, (ids[lo:hi] - np.uint64(layout.bases[b])).astype("<u4").tobytes(), n[lo:hi].astype("<u4").tobytes()) for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if lo < hi]
                yield _batch(parts, "word_bucket ranks n", (_I, _B, _B))

    return run


def _lower_part(table: pa.Table) -> pa.Table:
    ranks = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in table.column("ranks")])
    n = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in table.column("n")])
    ids, back = np.unique(ranks, return_inverse=True)
    whole = np.bincount(back, n, len(ids)).astype(np.int64)
    bucket = table.column("word_bucket")[0].as_py()
    return pa.Table.from_batches([_batch([(bucket, ids.tobytes(), whole.astype("<u4").tobytes(), _levels(whole).tolist(), int(whole.sum()))], "word_bucket ranks n levels total", (_I, _B, _B, pa.list_(_L), _L))])


def discounts(levels: list[int] | np.ndarray) -> np.ndarray:
    """Of counts 0, 1, 2 and 3 or more, from how many counts are 1 to 4; plain values where some are missing."""
    n1, n2, n3, n4 = (float(x) for x in levels)
    if not (n1 and n2 and n3):
        return np.array([0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    raw = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(raw, [0, 0.05, 0.1, 0.1], [0, 0.95, 1.9, 2.9])


class Mapped:
    """Arrays in one file of the worker's own folder, memory-mapped; the file goes as soon as it is mapped."""

    def __init__(self, **arrays: tuple[bytes, str]):
        fd, path = tempfile.mkstemp(prefix="lm-")
        with os.fdopen(fd, "wb") as out:
            for raw, _ in arrays.values():
                out.write(raw)
                out.write(b"\0" * (-len(raw) % 8))
        offset = 0
        for name, (raw, kind) in arrays.items():
            n = len(raw) // np.dtype(kind).itemsize
            setattr(self, name, np.memmap(path, kind, "r", offset, (n,)) if n else np.zeros(0, kind))
            offset += len(raw) + -len(raw) % 8
        os.unlink(path)


def _search(sorted_array: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_array):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_array, wanted), len(sorted_array) - 1)
    return at, sorted_array[at] == wanted


def _answered(layout: Layout, d: np.ndarray, hot_stats: np.ndarray):
    """To each block: of its bigrams the counts, of its contexts the totals and the weights of the lower order."""

    def run(queries: pa.Table, parts: pa.Table) -> pa.Table:
        part = (parts.to_pylist() or [{"keys": b"", "counts": b"", "contexts": b"", "stats": b""}])[0]
        m = Mapped(keys=(_sorted_keys(part).tobytes(), "<u8"), counts=(part["counts"], "<u4"), contexts=(part["contexts"], "<u8"), stats=(part["stats"], "<u4"))
        stats, rows = m.stats.reshape(-1, 4), []
        for row in queries.to_pylist():
            v, runs, w = layout.received(row)
            at, there = _search(m.keys, layout.key(np.repeat(v, runs), w))
            c = np.zeros(len(w), np.int64)
            c[there] = m.counts[at[there]]
            at, there = _search(m.contexts, v)
            own = np.zeros((len(v), 4))
            own[there] = stats[at[there]]
            at, spread = _search(layout.hot, v)
            own[spread] = hot_stats[at[spread]]
            total = np.maximum(own[:, 0], 1)
            weight = np.where(own[:, 0] > 0, own[:, 1:] @ d[1:] / total, 1.0)
            rows.append((row["block"], row["bucket"], len(w), len(v), _narrow(c), _narrow(total.astype(np.int64)), weight.astype("<f4").tobytes(), _narrow(runs)))
        return pa.Table.from_batches([_batch(rows, "block bucket n contexts counts totals weights runs", (_L, _I, _L, _L, _B, _B, _B, _B))])

    return run


def _lower_answers(asked: pa.Table, parts: pa.Table) -> pa.Table:
    """To each block, the distinct words before each of its words."""
    part = (parts.to_pylist() or [{"ranks": b"", "n": b""}])[0]
    known, n = np.frombuffer(part["ranks"], "<u4"), np.frombuffer(part["n"], "<u4")
    rows = []
    for row in asked.to_pylist():
        ranks = np.frombuffer(row["ranks"], "<u4")
        at, there = _search(known, ranks)
        before = np.zeros(len(ranks), np.int64)
        before[there] = n[at[there]]
        rows.append((row["block"], row["bucket"], _narrow(before)))
    return pa.Table.from_batches([_batch(rows, "block bucket before", (_L, _I, _B))])


def lower(n: np.ndarray, d: np.ndarray, total: int, words: int) -> np.ndarray:
    """p(w) from the distinct words before w; ``d[4]`` is the mass for the uniform distribution."""
    return np.maximum(n - d[np.minimum(n, 3)], 0) / max(total, 1) + d[4] / (words + 1)


def _scored(layout: Layout, totals: tuple[int, int], d: np.ndarray, lower_level: tuple[np.ndarray, int, int]):
    n_all, n_words = totals

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, vocabulary = Words(row), Vocabulary(row["answers"], layout.bases)
                v, w = words.bigrams(vocabulary.ids, layout.start)
                _, place = layout.sent(words.block, v, w, None)
                mine = sorted(row["scores"], key=lambda a: a["bucket"])
                n = np.concatenate([_widened(a["counts"], a["n"]) for a in mine])
                runs = [_widened(a["runs"], a["contexts"]) for a in mine]
                total = np.concatenate([np.repeat(_widened(a["totals"], a["contexts"]), r) for a, r in zip(mine, runs, strict=True)])
                weight = np.concatenate([np.repeat(np.frombuffer(a["weights"], "<f4"), r) for a, r in zip(mine, runs, strict=True)])
                share = np.maximum(n - d[np.minimum(n, 3)], 0) / total
                below = lower(vocabulary.before, *lower_level)[words.at]
                logs = np.log10(np.maximum(share[place] + weight[place] * below, 1e-300))
                c = vocabulary.counts[words.at]
                base = np.log10((c + 1) / (n_all + n_words + 1))
                lo, hi = words.rows[:-1], words.rows[1:]
                sums = [np.add.reduceat(x, lo) for x in (logs, base, (c > 0).astype(np.int64))]
                yield common.batch_of({
                    "doc_id": pa.array([x["c0"] for x in row["rows"]], pa.int64()), "held_out": pa.array([x["c1"] for x in row["rows"]], pa.bool_()), "n_tokens": hi - lo,
                    "n_known": sums[2], "train_tokens": np.full(len(lo), n_all), "base_score": sums[1], "score": sums[0],
                })

    return run


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``docs`` has ``doc_id``, ``held_out`` and ``text``; rows held out are scored but not learned from.  A null text is
    empty: one end token.  Rows with equal or null ``doc_id`` are documents of their own.  Without any training row all
    tokens are equally unknown.  An empty table gives no rows.
    """
    spark = common.shipped(docs.sparkSession)
    stage = common.Stage(spark)
    blocks = Blocks(common.keyed(docs, "doc_id", "held_out", "text"), stage, 4 << 20)
    n = blocks.n
    buckets = max(n, total_bytes(blocks.frame) // BUCKET_BYTES)

    counted = blocks.frame.select("block", "ends", "data", "rows").mapInArrow(_word_counts(buckets), "bucket int, block long, names binary, counts binary")
    answered = stage.save(counted.groupBy("bucket").applyInArrow(_word_ids, "block long, bucket int, n long, ranks binary, counts binary"), "words")
    stage.release()
    # one number of words for each bucket
    sizes = np.zeros(buckets, np.int64)
    for r in answered.where("block is null").select("bucket", "n").collect():
        sizes[r["bucket"]] = r["n"]
    bases = np.concatenate([[0], np.cumsum(sizes)])
    n_all, n_words = _totals(answered)
    hot = _hot(answered, bases, n_all / (HOT * buckets), int(bases[-1]))
    layout = Layout(buckets, bases, hot)

    words = answered.where("block is not null")
    by_block = words.groupBy("block").agg(F.collect_list(F.struct("bucket", "n", "ranks", "counts")).alias("answers"))
    pairs = blocks.met(by_block, "rows").mapInArrow(_bigrams(layout, True), _BIGRAMS)
    parts = bucketed(pairs.groupBy("bucket").applyInArrow(_part(layout), _PARTS), stage, "bigrams", "bucket", n)
    stage.release()
    levels = [r or 0 for r in parts.agg(*[F.sum(F.element_at("levels", i + 1)) for i in range(4)]).head()]
    d = discounts(levels)
    hot_stats = _hot_stats(parts, hot)

    below = parts.select("keys", "counts", "successors").mapInArrow(_lower_counts(layout), "word_bucket int, ranks binary, n binary")
    low = stage.save(below.groupBy("word_bucket").applyInArrow(_lower_part, "word_bucket int, ranks binary, n binary, levels array<long>, total long"), "lower")
    got = low.agg(F.sum("total"), *[F.sum(F.element_at("levels", i + 1)) for i in range(4)], F.sum(F.length("n") / 4)).head()
    total, low_levels, kinds = got[0] or 0, [x or 0 for x in got[1:5]], int(got[5] or 0)
    e = discounts(low_levels)
    mass = (e[1] * low_levels[0] + e[2] * low_levels[1] + e[3] * (kinds - low_levels[0] - low_levels[1])) / total if total else 1.0
    e = np.append(e, mass)
    lower_p = words.select("block", "bucket", "ranks").groupBy("bucket").cogroup(low.select(F.col("word_bucket").alias("bucket"), "ranks", "n").groupBy("bucket"))
    lower_p = stage.save(lower_p.applyInArrow(_lower_answers, "block long, bucket int, before binary"), "lower-answers")
    stage.drop("lower")
    stage.release()

    asked = blocks.met(by_block, "rows").mapInArrow(_bigrams(layout, False), _BIGRAMS).drop("counts").withColumn("counts", F.lit(b""))
    model = parts.select("bucket", "keys", "counts", "contexts", "stats")
    scores = asked.groupBy("bucket").cogroup(model.groupBy("bucket")).applyInArrow(_answered(layout, d, hot_stats), "block long, bucket int, n long, contexts long, counts binary, totals binary, weights binary, runs binary")
    scores = stage.save(scores, "scores")
    stage.drop("bigrams")
    stage.release()

    full = words.join(lower_p, ["block", "bucket"]).groupBy("block").agg(F.collect_list(F.struct("bucket", "n", "ranks", "counts", "before")).alias("answers"))
    by_bigram = scores.groupBy("block").agg(F.collect_list(F.struct("bucket", "n", "contexts", "counts", "totals", "weights", "runs")).alias("scores"))
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.met(full.join(by_bigram, "block"), "rows").mapInArrow(_scored(layout, (n_all, n_words), d, (e, total, n_words)), out)


def _totals(answered: DataFrame) -> tuple[int, int]:
    """Training tokens and distinct training words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("counts"):
                c = np.frombuffer(raw.as_buffer(), "<i8")
                yield _batch([(int(c.sum()), int((c > 0).sum()))], "tokens words", (_L, _L))

    got = answered.where("block is null").select("counts").mapInArrow(run, "tokens long, words long").agg(F.sum("tokens"), F.sum("words")).head()
    return got[0] or 0, got[1] or 0


def _hot(answered: DataFrame, bases: np.ndarray, least: float, start: int) -> np.ndarray:
    """Ids of the words (and the start) that a large share of the tokens follows; at most ``HOT * buckets`` and the start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, raw in zip(batch.column("bucket").to_pylist(), batch.column("counts"), strict=True):
                c = np.frombuffer(raw.as_buffer(), "<i8")
                ids = np.flatnonzero(c > least) + bases[bucket]
                yield _batch([(int(i),) for i in ids], "id", (_L,))

    got = answered.where("block is null").select("bucket", "counts").mapInArrow(run, "id long").collect()
    return np.array(sorted({start, *(r["id"] for r in got)}), np.uint64)


def _hot_stats(parts: DataFrame, hot: np.ndarray) -> np.ndarray:
    """Totals and counts of counts of the spread contexts, summed over the parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for contexts, stats in zip(batch.column("contexts"), batch.column("stats"), strict=True):
                at, there = _search(np.frombuffer(contexts.as_buffer(), "<u8"), hot)
                own = np.frombuffer(stats.as_buffer(), "<u4").reshape(-1, 4)
                yield _batch([(k, *own[at[k]].tolist()) for k in np.flatnonzero(there).tolist()], "k a b c d", (_L,) * 5)

    got = parts.select("contexts", "stats").mapInArrow(run, "k long, a long, b long, c long, d long").groupBy("k").agg(*[F.sum(x) for x in "abcd"]).collect()
    out = np.zeros((len(hot), 4))
    for r in got:
        out[r[0]] = r[1:]
    return out
