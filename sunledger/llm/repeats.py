"""Operator 6: bytes of repeated passages, found by sorting a difference cover of the suffixes.

With D a difference cover modulo v, any two places i and j of a text have a shift d below v so that both i + d and j + d
lie in D modulo v.  So two equal passages of ``PASSAGE`` bytes hold two sampled suffixes that agree on their first
``PASSAGE - v + 1`` bytes at least.  Three steps:

1. sort the sampled suffixes of all documents by the names of these prefixes; those with a name of their own are settled
   and leave (only names that repeat can be part of a repeat);
2. recurse on what is left: all suffixes within reach of a sample whose name repeats, named by ``PASSAGE`` bytes;
3. sort these names, so that equal prefixes are adjacent, and compare neighbours.

Only equality of prefixes is asked for, so names are hashes (64 bits and the bucket) and their order is that of the hashes.

Texts lie in blocks of some megabytes.  A block sends each distinct name once to the name's bucket and gets a bit back; the
blocks are bucketed by their number, so that answers meet them without moving texts again.  Exact copies of a text are
found the same way, by names of whole texts, and stand for one another from then on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.llm import common
from sunledger.llm.blocks import Blocks, total_bytes

PASSAGE = 200
#: A difference cover, each residue modulo PERIOD is a difference of two of its members.
PERIOD = 133
COVER = (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)
PREFIX = PASSAGE - PERIOD + 1

#: Sampled bytes of text for each bucket of names.
BUCKET_BYTES = 32 << 20

_TEXTS, _SAMPLES, _SUFFIXES = 0, 1, 2
_WIDTH = {_TEXTS: "<u8", _SAMPLES: "<u4", _SUFFIXES: "<u8"}
_SENT = "kind int, bucket int, block long, names binary"

_IN_COVER = np.zeros(PERIOD, bool)
_IN_COVER[list(COVER)] = True


class Names:
    """Distinct names of a block in ascending order, which is also bucket order; ``several`` tells those that the block has twice."""

    def __init__(self, h: np.ndarray):
        self.names, self.back, counts = np.unique(h, return_inverse=True, return_counts=True)
        self.several = counts > 1

    def sent(self, kind: int, block: int, buckets: int) -> list[tuple]:
        bucket = (self.names >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        low = self.names if kind != _SAMPLES else self.names & np.uint64(0xFFFFFFFF)
        low = low.astype(_WIDTH[kind])
        return [(kind, b, block, low[lo:hi].tobytes()) for b, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if lo < hi]

    def answered(self, kind: int, answers: list[dict], which: str = "repeated") -> np.ndarray:
        """A bit for each name."""
        mine = sorted((a for a in answers if a["kind"] == kind), key=lambda a: a["bucket"])
        bits = [np.unpackbits(np.frombuffer(a[which], np.uint8), count=a["n"]) for a in mine]
        return np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)


class Block:
    """Texts of a block: bytes, row ends, and what each step derives from them and from earlier answers."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.data = np.frombuffer(row["data"], np.uint8)
        self.ends = np.array(row["ends"], np.int64)
        self.sizes = np.diff(self.ends)
        self.prefix = common.Prefix(self.data)
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def texts(self) -> Names:
        raw = memoryview(np.ascontiguousarray(self.data))
        digests = [hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(self.ends[:-1].tolist(), self.ends[1:].tolist(), strict=True)]
        return Names(np.frombuffer(b"".join(digests), "<u8"))

    def sampled(self) -> tuple[np.ndarray, Names]:
        local = np.arange(len(self.data)) - self.ends[:-1][self.row]
        at = np.flatnonzero(_IN_COVER[local % PERIOD] & (local + PREFIX <= self.sizes[self.row]))
        return at, Names(self.prefix.ranges(at, at + PREFIX))

    def copies(self, answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose text stands elsewhere too, and those of them that another row stands for."""
        names = self.texts()
        repeated = names.answered(_TEXTS, answers) | names.several
        first = names.answered(_TEXTS, answers, "first")
        leads = np.zeros(len(self.sizes), bool)
        _, at = np.unique(names.back, return_index=True)
        leads[at] = first
        return repeated[names.back], repeated[names.back] & ~leads

    def suffixes(self, answers: list[dict], stood_for: np.ndarray) -> tuple[np.ndarray, Names]:
        """Starts of passages within reach of a sample whose name repeats."""
        at, names = self.sampled()
        mine = (names.answered(_SAMPLES, answers) | names.several)[names.back]
        at = at[mine]
        steps = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(steps, np.maximum(at - PERIOD + 1, self.ends[:-1][self.row[at]]), 1)
        np.add.at(steps, at + 1, -1)
        reach = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
        row = self.row[reach]
        reach = reach[(reach + PASSAGE <= self.ends[1:][row]) & ~stood_for[row]]
        return reach, Names(self.prefix.ranges(reach, reach + PASSAGE))

    def covered(self, answers: list[dict]) -> np.ndarray:
        """Bytes of repeated passages."""
        copied, stood_for = self.copies(answers)
        reach, names = self.suffixes(answers, stood_for)
        reach = reach[(names.answered(_SUFFIXES, answers) | names.several)[names.back]]
        steps = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(steps, reach, 1)
        np.add.at(steps, reach + PASSAGE, -1)
        out = np.cumsum(steps[:-1]) > 0
        return out | (copied & (self.sizes >= PASSAGE))[self.row]


def _sends(buckets: int, names_of: Callable[[Block, list[dict]], list[tuple[int, Names]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                rows = [x for kind, names in names_of(block, row.get("answers") or []) for x in names.sent(kind, block.number, buckets)]
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
                columns = list(zip(*rows, strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["kind", "bucket", "block", "names"])

    return run


def _solved(table: pa.Table) -> pa.Table:
    """For each block of a bucket: which of its names other blocks have too, and for which it is the first."""
    table = table.sort_by("block").combine_chunks()
    kind = table.column("kind")[0].as_py()
    parts = [np.frombuffer(x.as_buffer(), _WIDTH[kind]) for x in table.column("names")]
    names = np.concatenate(parts)
    order = np.argsort(names, kind="stable")
    names = names[order]
    same = names[1:] == names[:-1]
    repeated, first = np.zeros(len(names), bool), np.zeros(len(names), bool)
    repeated[order[1:]] |= same
    repeated[order[:-1]] |= same
    first[order] = np.concatenate([[True], ~same])
    edges = np.cumsum([0, *map(len, parts)])
    packed = [[np.packbits(x[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)] for x in (repeated, first)]
    n = pa.array(np.diff(edges), pa.int32())
    return pa.table({"block": table.column("block"), "kind": table.column("kind"), "bucket": table.column("bucket"), "n": n, "repeated": pa.array(packed[0], pa.binary()), "first": pa.array(packed[1] if kind == _TEXTS else [b""] * len(parts), pa.binary())})


def _first_names(block: Block, _: list[dict]) -> list[tuple[int, Names]]:
    return [(_TEXTS, block.texts()), (_SAMPLES, block.sampled()[1])]


def _second_names(block: Block, answers: list[dict]) -> list[tuple[int, Names]]:
    return [(_SUFFIXES, block.suffixes(answers, block.copies(answers)[1])[1])]


class Repeats:
    """Blocks of all texts with the answers to their names; ``map`` gives them with the covered bytes."""

    def __init__(self, docs: DataFrame):
        self.stage = common.Stage(docs.sparkSession)
        self.made = Blocks(docs, self.stage)
        self.rest, self.blocks = self.made.rest, self.made.frame
        self.buckets = max(self.made.n, total_bytes(self.blocks) // BUCKET_BYTES)
        first = self._answers(self.blocks.select("block", "ends", "data"), _first_names, "answers-1")
        self.answers = first
        self.answers = first.unionByName(self._answers(self._met(), _second_names, "answers-2"))

    def _met(self, *more: str) -> DataFrame:
        """Blocks with their answers; the blocks stay where their buckets are."""
        answers = self.answers.groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", "n", "repeated", "first")).alias("answers"))
        return self.made.met(answers, *more)

    def _answers(self, blocks: DataFrame, names_of: Callable, name: str) -> DataFrame:
        sent = blocks.mapInArrow(_sends(self.buckets, names_of), _SENT)
        out = "block long, kind int, bucket int, n int, repeated binary, first binary"
        return self.stage.save(sent.groupBy("kind", "bucket").applyInArrow(_solved, out), name)

    def map(self, func: Callable, schema: T.StructType | str) -> DataFrame:
        """``func(rows, block, covered)`` makes a record batch of each block."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    one = batch.slice(i, 1)
                    row = {c: one.column(c)[0].as_py() for c in ("block", "ends", "data", "answers")}
                    block = Block(row)
                    yield func(one.column("rows").flatten(), block, block.covered(row["answers"] or []))

        return self._met("rows").mapInArrow(run, schema)


def _digested(rows: pa.StructArray, block: Block, covered: np.ndarray) -> pa.RecordBatch:
    removed = np.concatenate([[0], np.cumsum(covered)])
    begins = covered & ~np.concatenate([[False], covered[:-1]])
    begins[block.ends[:-1][block.sizes > 0]] = covered[block.ends[:-1][block.sizes > 0]]
    spans = np.concatenate([[0], np.cumsum(begins)])
    lo, hi = block.ends[:-1], block.ends[1:]
    kept, at = block.data[~covered], block.ends - removed[block.ends]
    sha = [hashlib.sha256(kept[a:b].tobytes()).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return common.batch_of({"doc_id": rows.field("c0"), "n_bytes": block.sizes, "n_removed": removed[hi] - removed[lo], "n_spans": spans[hi] - spans[lo], "kept_sha256": pa.array(sha, pa.string())})


def removals(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row.

    A null text is empty; rows with equal or null ``doc_id`` are documents of their own, and copies of one another where
    their texts are equal.  Texts of less than ``PASSAGE`` bytes lose nothing.
    """
    return Repeats(common.keyed(docs, "doc_id", "text")).map(_digested, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the covered bytes cut out of ``text`` (and what a cut leaves of a character); null texts stay null."""
    made = Repeats(docs)
    order, rest = docs.columns, made.rest

    def cut(rows: pa.StructArray, block: Block, covered: np.ndarray) -> pa.RecordBatch:
        kept, at = block.data[~covered], block.ends - np.concatenate([[0], np.cumsum(covered)])[block.ends]
        absent = rows.field("absent").to_pylist()
        texts = [None if x else kept[a:b].tobytes().decode("utf-8", "ignore") for a, b, x in zip(at[:-1].tolist(), at[1:].tolist(), absent, strict=True)]
        columns = {c: rows.field(f"c{i}") for i, c in enumerate(rest)} | {"text": pa.array(texts, pa.string())}
        return common.batch_of({c: columns[c] for c in order})

    return made.map(cut, docs.schema)
