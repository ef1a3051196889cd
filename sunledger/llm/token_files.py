"""Operator 7: token ids of a corpus in files, with Elias-Fano coded document ends.

File format: a Parquet folder of blocks.  A block holds whole documents in ascending ``doc_id`` order: their ids
concatenated in ``ids`` (``width`` bytes each, little-endian) and the ends of the documents as an Elias-Fano sequence
(``low``, ``high``, ``low_bits``).  ``(part, block)`` order is ``doc_id`` order over the whole folder; ``start`` is
the number of ids of the part's blocks before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import common
from sunledger.llm.encode import CHUNK_BYTES, encoder, ended, little

BLOCK_TOKENS = 1 << 20
END_ID = 0

_BLOCKS = "part int, block int, start long, doc_ids array<long>, n_ids long, width int, ids binary, low_bits int, low binary, high binary"


class EliasFano:
    """A non-decreasing sequence of n integers below u in about n * (2 + log2(u / n)) bits.

    The low bits of each value stand side by side; the rest is unary in a bit string, where value k is the k-th one.
    ``select`` finds it from the number of ones before each 512 bits, without a table of offsets.
    """

    _EACH = 64  # bytes

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        ones = np.bitwise_count(self.high).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(np.add.reduceat(ones, np.arange(0, len(ones), self._EACH)))]) if len(ones) else np.zeros(1, np.int64)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        u = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (u // n).bit_length() - 1) if n else 0
        high = np.zeros((u >> low_bits) + n + 1, np.uint8)
        high[(values >> low_bits) + np.arange(n)] = 1
        low = (values[:, None] >> np.arange(low_bits)) & 1
        return cls(n, low_bits, np.packbits(low.astype(np.uint8), bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes())

    def _low(self, k: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(k), np.int64)
        at = k[:, None] * self.low_bits + np.arange(self.low_bits)
        bits = (self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits))

    def select(self, k: np.ndarray) -> np.ndarray:
        """Values at the places k (0 to n-1)."""
        k = np.asarray(k, np.int64)
        out = np.zeros(len(k), np.int64)
        group = np.searchsorted(self.before, k, "right") - 1
        order = np.argsort(group, kind="stable")
        edges = np.flatnonzero(np.diff(group[order], prepend=-1))
        for lo, hi in zip(edges, [*edges[1:], len(order)], strict=True):
            mine, g = order[lo:hi], int(group[order[lo]])
            ones = np.flatnonzero(np.unpackbits(self.high[g * self._EACH : (g + 1) * self._EACH], bitorder="little"))
            out[mine] = ones[k[mine] - self.before[g]] + g * self._EACH * 8
        return ((out - k) << self.low_bits) | self._low(k)

    def bits(self) -> int:
        return 8 * (len(self.low) + len(self.high))


def _written(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, block = encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids, sizes, docs, held, before = [], [], [], 0, 0

        def out():
            ends = EliasFano.of(np.cumsum(np.concatenate(sizes)))
            raw = np.concatenate(ids).astype(enc.dtype).astype(f"<u{enc.width}").tobytes()
            one = [part, block, before, [x for d in docs for x in d], held, enc.width, raw, ends.low_bits, ends.low.tobytes(), ends.high.tobytes()]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
            names = ["part", "block", "start", "doc_ids", "n_ids", "width", "ids", "low_bits", "low", "high"]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(one, kinds, strict=True)], names=names)

        for piece, data, rows in common.chunks(batches, limit=CHUNK_BYTES, kind="encoders"):
            got, ends = ended(*enc.encode(data, rows), END_ID)
            named, lo = piece.column("doc_id").to_pylist(), 0
            while lo < len(named):
                # whole documents as long as they fit; one that is longer than a block is a block of its own
                hi = int(np.searchsorted(ends, ends[lo] + BLOCK_TOKENS - held, "right")) - 1
                if hi <= lo and held:
                    yield out()
                    ids, sizes, docs, before, held, block = [], [], [], before + held, 0, block + 1
                    continue
                hi = max(hi, lo + 1)
                ids.append(got[ends[lo] : ends[hi]])
                sizes.append(np.diff(ends[lo : hi + 1]))
                docs.append(named[lo:hi])
                held, lo = held + int(ends[hi] - ends[lo]), hi
        if ids:
            yield out()

    return run


def write(docs: DataFrame, folder: str, tokenizer: str) -> None:
    """Write the ids of all texts, an end id after each, as blocks in ascending ``doc_id`` order.

    A null text is empty (its end id alone); null ``doc_id`` come first; rows of equal ``doc_id`` all stay, in any order
    among themselves.  An empty table gives an empty folder with the schema.
    """
    spark = common.shipped(docs.sparkSession)
    rows = common.keyed(docs, "doc_id", "text").repartitionByRange(common.partitions(spark), "doc_id").sortWithinPartitions("doc_id")
    rows.mapInArrow(_written(tokenizer), _BLOCKS).write.option("compression", "zstd").mode("overwrite").parquet(folder)


def part_starts(blocks: DataFrame) -> dict[int, int]:
    """Ids before each part: one number for each written partition goes through the driver."""
    total, out = 0, {}
    for row in sorted(blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()):
        out[row["part"]] = total
        total += row["n"]
    return out


def _read(starts: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["doc_ids"])
                ends = EliasFano(n, row["low_bits"], row["low"], row["high"]).select(np.arange(n))
                ids = little(np.frombuffer(row["ids"], f"<u{row['width']}"))
                begins = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                start = begins + (starts[row["part"]] + row["start"])
                yield common.batch_of({"doc_id": pa.array(row["doc_ids"], pa.int64()), "start": start, "n_tokens": ends - begins, "ids_crc32": pa.array(crc, pa.int64())})

    return run


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files alone."""
    blocks = common.shipped(spark).read.schema(_BLOCKS).parquet(folder)
    return blocks.mapInArrow(_read(part_starts(blocks)), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _texts(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["doc_ids"])
                ends = EliasFano(n, row["low_bits"], row["low"], row["high"]).select(np.arange(n))
                ids = np.frombuffer(row["ids"], f"<u{row['width']}")
                parts = [x[:-1].tolist() for x in np.split(ids, ends[:-1])]
                yield common.batch_of({"doc_id": pa.array(row["doc_ids"], pa.int64()), "text": pa.array(enc.tokenizer.decode_batch(parts, skip_special_tokens=False), pa.string())})

    return run


def read_texts(spark: SparkSession, folder: str, tokenizer: str) -> DataFrame:
    """The texts again, decoded from the files."""
    return common.shipped(spark).read.schema(_BLOCKS).parquet(folder).mapInArrow(_texts(tokenizer), "doc_id long, text string")
