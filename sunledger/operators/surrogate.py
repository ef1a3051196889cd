"""Dense numbers for rows that have a natural key, as the ``id`` columns of the base tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunledger.sources.scratch import scratch_dir

#: ``monotonically_increasing_id`` has the row of a partition in its low bits and the partition above.
_ROW_BITS = 33


def numbered(df: DataFrame, keys: Sequence[str], *, after: int = 0, column: str = "id", work_dir: str | None = None) -> DataFrame:
    """``df`` with numbers ``after + 1``, ``after + 2``, ... in the order of ``keys``, without a gap.

    The rows are dealt out by ranges of their keys and sorted there; a row's number is its place in its range and the
    rows of the ranges before it, so no task sees more than one range.  They are staged first, as a sort that is done
    again after a lost executor might deal them out otherwise.  Of rows with equal keys either may come first.
    """
    staged = f"{scratch_dir(df.sparkSession, work_dir)}/numbered"
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__place", F.monotonically_increasing_id())
    placed.write.parquet(staged)
    rows = df.sparkSession.read.parquet(staged).withColumn("__range", F.shiftright("__place", _ROW_BITS))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each range
    starts = rows.groupBy("__range").agg(F.count("*").alias("__n")).select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    number = F.col("__start") + F.col("__place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + F.lit(after + 1)
    return rows.join(starts, "__range").select(number.cast("int").alias(column), *df.columns)


def insert_numbered(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], *, column: str = "id", work_dir: str | None = None) -> DataFrame:
    """Stored rows, whose numbers stay, and the incoming ones whose key is new, numbered from the largest on.

    ``incoming`` is unique by ``keys``; its columns are those of ``stored`` without the number.
    """
    last = stored.agg(F.max(column)).head()[0] or 0
    new = incoming.join(stored.select(*keys), list(keys), "left_anti").select(*[c for c in stored.columns if c != column])
    return stored.unionByName(numbered(new, keys, after=last, column=column, work_dir=work_dir))
