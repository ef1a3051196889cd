"""Which keys a partition may hold, without reading them: a Bloom filter beside each part of a table.

A partition's filter has ``words`` numbers of 64 bits.  A key sets three bits of one of them, so the filter of a part is the
``bit_or`` of its keys grouped by word, and a look-up is an equi join on (partition, word).  At 12 bits a key about one
absent key in thirty seems to be there; then, and for keys that are there, the partition's keys are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.operators.upsert import NAMED_PARTITIONS, insert_if_absent
from sunledger.sources.scratch import exists, remove, scratch_dir
from sunledger.sources.versioned import Manifest, VersionedTable, values_of

#: Words of a partition's filter: enough for 90,000 keys at 12 bits each.
WORDS = 1 << 14

_FIELDS = "word int, bits bigint"


def _word(keys: Sequence[str], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(words)).cast("int")


def _bits(keys: Sequence[str]) -> Column:
    h = F.xxhash64(F.lit("bits"), *keys)
    one = F.lit(1).cast("bigint")
    places = [F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(3)]
    first, second, third = (F.call_function("shiftleft", one, p) for p in places)
    return first.bitwiseOR(second).bitwiseOR(third)


def marks(rows: DataFrame, keys: Sequence[str], partition: str, words: int = WORDS) -> DataFrame:
    """The filters of the partitions of ``rows``: (partition, word, bits)."""
    marked = rows.select(partition, _word(keys, words).alias("word"), _bits(keys).alias("bits"))
    return marked.groupBy(partition, "word").agg(F.bit_or("bits").alias("bits"))


def possibly_present(rows: DataFrame, filters: DataFrame, keys: Sequence[str], partition: str, words: int = WORDS) -> DataFrame:
    """Rows whose key the filters do not rule out; never leaves out one that is there."""
    held = filters.groupBy(partition, "word").agg(F.bit_or("bits").alias("__bits"))
    met = rows.withColumn("word", _word(keys, words)).withColumn("__own", _bits(keys)).join(held, [partition, "word"])
    return met.where(F.col("__bits").bitwiseAND(F.col("__own")) == F.col("__own")).select(*rows.columns)


class Presence:
    """The filters beside a versioned table, below ``marks/part=<id>``."""

    def __init__(self, table: VersionedTable, keys: Sequence[str], words: int = WORDS):
        self.table, self.keys, self.words = table, tuple(keys), words

    def _path(self, part: str) -> str:
        return f"{self.table.path}/marks/part={part}"

    def write(self, part: str) -> None:
        """The filters of a part that has been written and is not published yet."""
        spark, name = self.table.spark, self.table.partition
        if exists(spark, f"{self.table.path}/data/part={part}"):
            rows = spark.read.schema(f"{self.table.schema}, {name} string").parquet(f"{self.table.path}/data/part={part}")
            marks(rows, self.keys, name, self.words).hint("rebalance", name).write.partitionBy(name).parquet(self._path(part))

    def read(self, state: Manifest, partitions: Sequence[str]) -> tuple[DataFrame, list[str]]:
        """Filters of some partitions, and those of them that have a part without one."""
        spark, name = self.table.spark, self.table.partition
        wanted = [(p, i) for p in partitions for i in state.parts.get(p, [])]
        there = {i: exists(spark, self._path(i)) for i in {i for _, i in wanted}}
        unmarked = sorted({p for p, i in wanted if not there[i]})
        folders = [f"{self._path(i)}/{name}={p}" for p, i in wanted if there[i]]
        schema = f"{_FIELDS}, {name} string"
        if not folders:
            return spark.createDataFrame([], schema), unmarked
        return spark.read.schema(schema).option("basePath", f"{self.table.path}/marks").parquet(*folders).drop("part"), unmarked


def insert_absent(table: VersionedTable, incoming: DataFrame, keys: Sequence[str], partition_value: Column, words: int = WORDS, work_dir: str | None = None) -> Manifest:
    """Add the incoming rows whose key the table does not have; of several with one key the smallest.

    Only partitions of the delivery are looked at: first their filters, then the keys of those where one may be there
    already.  All is published in one step, so a repeated delivery, also after a failure, adds nothing twice.
    """
    spark, name = table.spark, table.partition
    landed = f"{scratch_dir(spark, work_dir)}/absent"
    one = insert_if_absent(spark.createDataFrame([], table.schema), incoming, keys)
    one.withColumn(name, partition_value).write.parquet(landed)
    fresh = spark.read.parquet(landed)
    presence = Presence(table, keys, words)

    def change(state: Manifest) -> Manifest:
        touched = values_of(fresh, name, NAMED_PARTITIONS)
        touched = sorted(state.parts) if touched is None else touched
        filters, unmarked = presence.read(state, touched)
        maybe = possibly_present(fresh, filters, keys, name, words)
        looked_up = values_of(maybe, name, len(touched)) or []
        known = table.read(state, {*looked_up, *unmarked}).select(*keys)
        new = fresh.join(known, list(keys), "left_anti") if looked_up or unmarked else fresh
        part, found = table.write_part(new, keys)
        if not found:
            return state
        presence.write(part)
        return table.commit(state, {p: [*state.parts.get(p, []), part] for p in found})

    done = table.retried(change)
    remove(spark, landed)
    return done
