"""Operator 5: best-fit packing of token pieces into sequences of a fixed length.

Pieces are numbered among those of equal length (range sort by length, then rank).  Since equal lengths are
interchangeable, the sorted lists of pieces and of gaps are kept run-length coded: at most ``capacity`` runs of pieces,
and runs of gaps whose number the capacity bounds too, whatever the input.  A superstep takes the longest open length,
sweeps over its successors among the gaps (the smallest gap that fits), resolves the conflict of pieces for a gap by
rank, updates the gaps and repeats; what no gap takes opens new sequences.  This gives the packing of sequential
best-fit-decreasing.  The runs' matches go to the tasks, which place every piece by its rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm import common
from sunledger.llm.encode import CHUNK_BYTES, encoder, ended

CAPACITY = 2048
END_ID = 0
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _cut(tokenizer: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for some, data, ends in common.chunks(batches, limit=CHUNK_BYTES, kind="encoders"):
            ids, upto = ended(*enc.encode(data, ends), END_ID)
            sizes = np.diff(upto)
            n = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            first = sizes - (n - 1) * capacity
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[doc], capacity)
            # how many of that length the task has seen before
            order = np.argsort(length, kind="stable")
            nth = np.empty(len(doc), np.int64)
            nth[order] = seen[length[order]] + np.arange(len(doc)) - np.searchsorted(length[order], length[order])
            seen += np.bincount(length, minlength=capacity + 1)
            lo = upto[:-1][doc] + start
            crc = [zlib.crc32(ids[x:y]) for x, y in zip(lo.tolist(), (lo + length).tolist(), strict=True)]
            yield common.batch_of({
                "doc_id": some.column("doc_id").cast(pa.int64()).take(pa.array(doc)), "piece": piece.astype(np.int32), "start": start, "length": length,
                "ids_crc32": pa.array(crc, pa.int64()), "part": np.full(len(doc), part, np.int32), "nth": nth,
            })

    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of all documents: ids of the text, then the end id; longer ones cut, the first piece the shorter one.

    ``part`` and ``nth`` number the pieces of equal length within a task.
    """
    common.shipped(docs.sparkSession)
    return common.keyed(docs, "doc_id", "text").mapInArrow(_cut(tokenizer, capacity), _PIECES)


def supersteps(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Matches of runs: ``(length, first rank, first sequence, pieces in each sequence, offset there)``.

    From that rank on, each group of that many pieces goes to the next sequence.  ``gaps`` has runs of sequences by room.
    """
    out: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    opened = 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in gaps:
                gaps[room] = []
                insort(rooms, room)
            gaps[room].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = gaps[room].pop()
                if not gaps[room]:
                    del gaps[room], rooms[at]
            else:
                room, first = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            each = room // length
            full = min(n, left // each)
            if full:
                out.append((length, rank, first, each, capacity - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < n:
                rest = left if left < each else 0
                if rest:
                    out.append((length, rank, first + full, rest, capacity - room))
                    put(room - rest * length, first + full, 1)
                    rank, left = rank + rest, 0
                put(room, first + full + bool(rest), n - full - bool(rest))
    return out


def _place(plan: np.ndarray):
    key = plan[:, 0] << 44 | plan[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("nth").to_numpy() + batch.column("base").to_numpy()
            _, first_rank, first, each, offset = plan[np.searchsorted(key, length << 44 | rank, "right") - 1].T
            nth = rank - first_rank
            same = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            yield common.batch_of(same | {"sequence_id": first + nth // each, "offset": offset + nth % each * length})

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Place all pieces in as few sequences as best-fit-decreasing needs, gapless from offset 0.

    A null or empty text is a piece of one end id.  A text of any length is cut whole.  Rows with equal or null ``doc_id``
    are documents of their own.  An empty table gives no rows.
    """
    stage = common.Stage(docs.sparkSession)
    cut = stage.save(pieces(docs, tokenizer, capacity), "pieces")
    sizes = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    base = sizes.select("length", "part", F.expr("sum(n) over (partition by length order by part rows between unbounded preceding and current row) - n").alias("base"))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    plan = np.array(sorted(supersteps(counts, capacity)) or [(0, 0, 0, 1, 0)], np.int64)
    return cut.join(base, ["length", "part"]).mapInArrow(_place(plan), _PLACED)
