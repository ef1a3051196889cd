"""Operator 13: ranked lexical search that scores each class of equal bags once.

Documents are cut down to the vocabulary of the items: a bag holds (term, tf) pairs in ascending order.  The score of a
document depends on its bag and on ``m`` (its length against the mean length) alone.  So documents are dealt out by a hash
of bag and ``m``, equal hashes are told apart by the bag itself, and each class is scored once; a class then gives its
members in ascending ``doc_id``.  Only a class's first ``TOP`` members can be among an item's first ``TOP`` documents, so a
map task sends no more of them (a group limit before the shuffle) however many copies there are.

Items go in blocks of bounded size: their vocabulary and which item has which term is sent to all executors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sunledger.llm import common, wordlists

TOP = 50
#: Distinct terms and items of a block; a term has some 20 bytes, a pair of item and term 8.
BLOCK_TERMS, BLOCK_ITEMS, BLOCK_PAIRS = 200_000, 4_000, 1_000_000
#: Scores held at once: items times classes.
_CELLS = 1 << 21

#: Anything but digits, letters and what lies beyond ASCII.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[:0x30] = SEPARATOR[0x3A:0x41] = SEPARATOR[0x5B:0x61] = SEPARATOR[0x7B:0x80] = True


@dataclass
class Items:
    """Items of a block by number, their distinct terms (sorted, each with a blank), and the items of each term."""

    ids: list
    terms: pa.LargeBinaryArray
    ends: np.ndarray
    items: np.ndarray


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some, data, ends in common.chunks(batches):
        words, stops, rows = wordlists.spaced(common.LOWER[data], ends, SEPARATOR)
        ids, distinct = wordlists.numbered(words, stops)
        pairs = np.unique(np.repeat(np.arange(len(ends) - 1), np.diff(rows)) * max(len(distinct), 1) + ids)
        row, term = np.divmod(pairs, max(len(distinct), 1))
        yield common.batch_of({"item_id": some.column("item_id").take(pa.array(row)), "term": distinct.take(pa.array(term)).cast(pa.binary())})


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """Items with their distinct terms, in blocks; rows of one ``item_id`` (or of null) are one item."""
    found = common.keyed(items, "item_id", "text").mapInArrow(_terms, f"item_id {items.schema['item_id'].dataType.simpleString()}, term binary")
    listed = found.distinct().groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    held, terms, pairs = [], set(), 0
    for row in listed.toLocalIterator(prefetchPartitions=True):
        own = [bytes(t) for t in row["terms"]]
        new = sum(t not in terms for t in own)
        if held and (len(held) >= BLOCK_ITEMS or pairs + len(own) > BLOCK_PAIRS or len(terms) + new > BLOCK_TERMS):
            yield _block(held)
            held, terms, pairs = [], set(), 0
        held.append((row["item_id"], own))
        terms.update(own)
        pairs += len(own)
    if held:
        yield _block(held)


def _block(held: list[tuple]) -> Items:
    terms = sorted({t for _, own in held for t in own})
    number = {t: i for i, t in enumerate(terms)}
    pairs = np.array([(number[t], i) for i, (_, own) in enumerate(held) for t in own], np.int64).reshape(-1, 2)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return Items([i for i, _ in held], pa.array(terms, pa.large_binary()), np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1)), pairs[:, 1])


def bags(docs: DataFrame, items: Items) -> DataFrame:
    """``doc_id, n`` (all terms with repeats) and ``bag``: (term, tf) as pairs of 32-bit numbers, terms of the items only."""
    shared = docs.sparkSession.sparkContext.broadcast(items.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        size = max(len(vocabulary), 1)
        for some, data, ends in common.chunks(batches):
            words, stops, rows = wordlists.spaced(common.LOWER[data], ends, SEPARATOR)
            ids, distinct = wordlists.numbered(words, stops)
            term = pc.index_in(distinct, value_set=vocabulary).fill_null(-1).to_numpy().astype(np.int64)[ids]
            row = np.repeat(np.arange(len(ends) - 1), np.diff(rows))[term >= 0]
            pairs, tf = np.unique(row * size + term[term >= 0], return_counts=True)
            row, term = np.divmod(pairs, size)
            raw = np.column_stack([term, tf]).astype("<u4")
            upto = (8 * np.searchsorted(row, np.arange(len(ends)))).astype(np.int32)
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(upto), pa.py_buffer(raw)])
            yield common.batch_of({"doc_id": some.column("doc_id").cast(pa.int64()), "n": np.diff(rows), "bag": packed})

    return common.keyed(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n long, bag binary")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(term, tf) rows of some bags, and the n+1 ends of the bags in them."""
    raw, ends = wordlists.bytes_of(column.cast(pa.large_binary()))
    return raw.view("<u4").reshape(-1, 2).astype(np.int64), ends // 8


def _frequencies(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column("bag"))[0][:, 0], minlength=size)
        term = np.flatnonzero(total)
        yield common.batch_of({"term": term, "df": total[term]})

    return run


def classes(found: DataFrame, documents: int, terms: int, top: int = TOP) -> DataFrame:
    """``bag, m, members``: documents of equal bag and ``m``, of each class the first ``top`` in ascending ``doc_id``, null last.

    A document without any term of the items is in no class.
    """
    # n, N and L are 64-bit; their product may not be
    m = F.expr(f"50 + (cast(50 * n as decimal(20, 0)) * cast({documents} as decimal(18, 0))) div {max(terms, 1)}")
    dealt = found.where("length(bag) > 0").select("doc_id", "bag", m.cast("long").alias("m")).withColumn("hash", F.xxhash64("bag", "m"))
    own = Window.partitionBy("hash", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last())
    first = dealt.withColumn("place", F.row_number().over(own)).where(F.col("place") <= top)
    members = F.array_sort(F.collect_list(F.struct("place", "doc_id")))
    return first.groupBy("hash", "m", "bag").agg(F.transform(members, lambda x: x["doc_id"]).alias("members")).select("bag", "m", "members")


class Best:
    """The ``top`` documents of each item so far."""

    def __init__(self, top: int):
        self.top, self.rows = top, [np.zeros(0, np.int64) for _ in range(4)]

    def cut(self, item: np.ndarray, score: np.ndarray, absent: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Rows in order of item, falling score and rising ``doc_id``, as far as they are among the first ``top``."""
        order = np.lexsort((doc, absent, -score, item))
        sorted_items = item[order]
        rank = np.arange(len(order)) - np.searchsorted(sorted_items, sorted_items)
        return order[rank < self.top]

    def add(self, scores: np.ndarray, ends: np.ndarray, absent: np.ndarray, doc: np.ndarray) -> None:
        """``scores`` by item and class; the members of class c are those from ``ends[c]`` to ``ends[c + 1]``."""
        n = scores.shape[1]
        floor = np.maximum(np.partition(scores, n - self.top, axis=1)[:, n - self.top] if n > self.top else 1, 1)
        item, at = np.nonzero(scores >= np.broadcast_to(floor, len(scores))[:, None])
        score = scores[item, at]
        # classes by their first members: an item's first documents lie in as many first classes at most
        keep = self.cut(item, score, absent[ends[at]], doc[ends[at]])
        item, at, score = item[keep], at[keep], score[keep]
        size = np.diff(ends)[at]
        member = np.arange(size.sum()) + np.repeat(ends[at] - np.cumsum(size) + size, size)
        new = (np.repeat(item, size), np.repeat(score, size), absent[member], doc[member])
        rows = [np.concatenate(x) for x in zip(self.rows, new, strict=True)]
        keep = self.cut(*rows)
        self.rows = [x[keep] for x in rows]


def _scored(shared, weights: np.ndarray, top: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        best, step = Best(top), max(_CELLS // max(len(items.ids), 1), 64)
        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                batch = whole.slice(lo, step)
                pairs, ends = _flat(batch.column("bag"))
                own = np.repeat(np.arange(batch.num_rows), np.diff(ends))
                m = batch.column("m").to_numpy()[own]
                term, tf = pairs[:, 0], pairs[:, 1]
                gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m))
                order = np.argsort(term, kind="stable")
                term, own, gain = term[order], own[order], gain[order]
                edges = np.flatnonzero(np.diff(term, prepend=-1, append=-1))
                scores = np.zeros((len(items.ids), batch.num_rows), np.int64)
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    asked = items.items[items.ends[term[a]] : items.ends[term[a] + 1]]
                    scores[asked[:, None], own[a:b]] += gain[a:b]
                members = batch.column("members")
                upto = np.asarray(members.offsets, np.int64)
                flat = members.flatten()
                absent = flat.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                best.add(scores, upto - upto[0], absent, flat.fill_null(0).to_numpy())
        item, score, absent, doc = best.rows
        ids = pa.array([items.ids[i] for i in item.tolist()], kind)
        yield common.batch_of({"item_id": ids, "doc_id": pa.array(doc, mask=absent.astype(bool)), "score": score})

    return run


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above 0, equal scores by ``doc_id``.

    A term is a run of ASCII digits, letters (A-Z lower-cased) and anything beyond ASCII.  A null text has none.  Rows of one
    ``doc_id`` are documents of their own; a null ``doc_id`` comes after all others of its score.  Rows of one ``item_id``
    are one item; an item without terms, or whose terms stand nowhere, has no row; so have empty tables.  Texts may be of any
    length.  Other columns are not read.
    """
    spark = common.shipped(docs.sparkSession)
    stage, parts = common.Stage(spark), []
    out = f"item_id {items.schema['item_id'].dataType.simpleString()}, doc_id long, score long"
    kind = to_arrow_type(items.schema["item_id"].dataType)
    for i, block in enumerate(item_blocks(items)):
        found = stage.save(bags(docs, block), f"bags-{i}")
        documents, terms = found.where("n > 0").agg(F.count("*"), F.sum("n")).head()
        counts = found.select("bag").mapInArrow(_frequencies(len(block.terms)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        weights = np.zeros(len(block.terms), np.int64)
        for row in counts.collect():
            weights[row["term"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * row["df"] + 1)))
        shared = spark.sparkContext.broadcast(block)
        parts.append(classes(found, documents, terms or 0, top).mapInArrow(_scored(shared, weights, top, kind), out))
    if not parts:
        return spark.createDataFrame([], out).select("item_id", F.lit(0).alias("rank"), "doc_id", "score")
    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
