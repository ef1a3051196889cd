"""What the corpus operators share: staged tables, byte chunks of a text column, hashed words."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What tasks of one kind keep in a worker for the next ones.
KEPT: dict[str, dict] = {}

#: Bytes of text that numpy temporaries are made for at once; one longer text is a chunk of its own.
CHUNK_BYTES = 2 << 20

_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)

#: White space as the word contracts have it, and A-Z to a-z.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def shipped(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it (a cluster gets it by ``--py-files``)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(":")
    if root not in paths:
        env["PYTHONPATH"] = ":".join(filter(None, [root, *paths]))
    return spark


class Stage:
    """Tables written below ``spark.checkpoint.dir``, which all executors share; they cut lineage and survive lost executors.

    Only a local session without that setting gets a temporary folder.
    """

    def __init__(self, spark: SparkSession):
        self.spark = shipped(spark)
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            base = tempfile.mkdtemp(prefix="sunledger-")
        self.dir = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}"

    def save(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        df.write.option("compression", codec).mode("overwrite").parquet(self.path(name))
        return self.load(name, df.schema)

    def load(self, name: str, schema=None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(name))

    def release(self) -> None:
        """Let Spark remove the shuffle files of finished steps now; its cleaner acts on what the JVM has collected."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, name: str) -> None:
        """Remove a staged table that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_map(df: DataFrame, func: Callable, schema: str) -> DataFrame:
    return df.mapInArrow(func, schema)


def batch_of(columns: dict[str, object], schema: pa.Schema | None = None) -> pa.RecordBatch:
    arrays = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x) for x in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the n+1 ends of its rows; null is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def forget(but: str | None = None) -> None:
    """Give back what tasks of other kinds left in this worker, which Spark uses again."""
    for kind, what in KEPT.items():
        if kind != but:
            what.clear()
    pa.default_memory_pool().release_unused()


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES, kind: str | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with their text bytes and row ends, each of about ``limit`` bytes or of one longer row.

    ``kind`` names what tasks of this kind have ``KEPT``.
    """
    forget(kind)
    for batch in batches:
        data, ends = texts_of(batch.column(column))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit, "right")) - 1)
            hi = min(hi, n)
            yield batch.slice(lo, hi - lo), data[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo]
            lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every bit depends on every bit (the finaliser of splitmix64)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}
KEPT["powers"] = _POWERS


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for n positions."""
    if not _POWERS or len(_POWERS["up"]) < n:
        for name, b in (("up", _BASE), ("down", np.uint64(pow(int(_BASE), -1, 1 << 64)))):
            _POWERS[name] = np.full(n + 1, b, np.uint64)
            _POWERS[name][0] = 1
            np.cumprod(_POWERS[name], out=_POWERS[name])
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Prefix:
    """Prefix sums of a polynomial, so that the hash of any byte range is a difference."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def ranges(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix((self.sums[stops] - self.sums[starts]) * self.down[starts])

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all ranges of that width, by start."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)


def word_spans(is_word: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and stops of the words (runs of true within a row) and n+1 word ends of the rows."""
    n = len(is_word)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(ends), np.int64)
    first = np.zeros(n + 1, bool)
    first[ends] = True
    before = np.concatenate([[False], is_word[:-1]]) & ~first[:n]
    after = np.concatenate([is_word[1:], [False]]) & ~first[1:]
    starts, stops = np.flatnonzero(is_word & ~before), np.flatnonzero(is_word & ~after) + 1
    return starts, stops, np.searchsorted(starts, ends)


def hashed_words(data: np.ndarray, ends: np.ndarray, is_separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of a chunk, and the n+1 word ends of its rows."""
    starts, stops, rows = word_spans(~is_separator[data], ends)
    return Prefix(LOWER[data]).ranges(starts, stops), rows


def shingles(words: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words within rows (a shorter, not empty row is one run), and their row ends."""
    counts = np.diff(rows)
    n = np.where(counts == 0, 0, np.maximum(counts - width + 1, 1))
    stop = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(len(counts)), n)
    start = rows[:-1][row] + (np.arange(stop[-1]) - stop[:-1][row])
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    left = rows[1:][row] - start
    h = np.zeros(len(start), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            h = (h * _MUL + np.where(k < left, padded[start + k] | np.uint64(1), np.uint64(0))) if k else padded[start] * _BASE
    return mix(h), stop


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the columns an operator reads; what else a table has, under whatever name, stays out."""
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def fresh(name: str, taken: list[str]) -> str:
    """The name, with underscores before it until no taken one is like it."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name
