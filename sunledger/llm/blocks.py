"""Texts in blocks of some megabytes that answers can meet without moving the texts again."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.llm import common

BLOCK_BYTES = 2 << 20


def _blocked(rest: list[str], limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def out():
            data = b"".join(x[1].tobytes() for x in held)
            ends = np.cumsum(np.concatenate([[0], *[np.diff(x[2]) for x in held]]))
            rows = pa.Table.from_batches([x[0] for x in held]).combine_chunks()
            absent = rows.column("text").is_null().combine_chunks()
            fields = [rows.column(c).combine_chunks() for c in rest]
            struct = pa.StructArray.from_arrays([*fields, absent], names=[*[f"c{i}" for i in range(len(rest))], "absent"])
            lists = pa.ListArray.from_arrays(pa.array([0, len(struct)], pa.int32()), struct)
            return common.batch_of({"block": pa.array([number], pa.int64()), "ends": pa.array([ends], pa.list_(pa.int64())), "data": pa.array([data], pa.binary()), "rows": lists})

        for some, data, ends in common.chunks(batches, limit=limit // 4):
            held.append((some, data, ends))
            size += len(data)
            if size >= limit:
                yield out()
                held, size, number = [], 0, number + 1
        if held:
            yield out()

    return run


class Blocks:
    """A staged table of blocks, bucketed by their number: ``block``, ``ends`` and ``data`` of the texts, and in ``rows``
    the other columns (``c0``, ``c1``, ... in the order of ``rest``) and whether a text was ``absent``.
    """

    def __init__(self, docs: DataFrame, stage: common.Stage, limit: int = BLOCK_BYTES):
        self.rest = [c for c in docs.columns if c != "text"]
        self.n = common.partitions(docs.sparkSession)
        fields = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(self.rest)]
        rows = T.StructType([*fields, T.StructField("absent", T.BooleanType())])
        schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("data", T.BinaryType()), T.StructField("rows", T.ArrayType(rows))])
        self.frame = bucketed(docs.mapInArrow(_blocked(self.rest, limit), schema), stage, "blocks", "block", self.n)

    def met(self, answers: DataFrame, *more: str) -> DataFrame:
        """Blocks with their row of ``answers``, if any; the blocks stay where their buckets are."""
        return self.frame.select("block", "ends", "data", *more).join(answers.hint("merge"), "block", "left")


def bucketed(df: DataFrame, stage: common.Stage, name: str, key: str, n: int) -> DataFrame:
    table = f"sunledger_{name}_{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("path", stage.path(name)).bucketBy(n, key).saveAsTable(table, format="parquet")
    return df.sparkSession.table(table)


def total_bytes(frame: DataFrame) -> int:
    return frame.agg(F.sum(F.element_at("ends", -1))).head()[0] or 0
