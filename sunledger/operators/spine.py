"""Generated time series."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions.timecols import NTZ, as_ntz, date_lit


def quarter_hours(df: DataFrame, first_day: Column, as_of: date, alias: str = "ts") -> DataFrame:
    """All quarter hours from a day's midnight up to, without, the midnight after ``as_of``.

    Days are expanded first and spread over the cluster before each becomes 96 rows.
    """
    days = df.withColumn("__d", F.explode(F.sequence(first_day, date_lit(as_of)))).repartition(*_keys(df), "__d")
    slot = F.explode(F.sequence(F.lit(0), F.lit(95)))
    return days.withColumn("__s", slot).select(
        *df.columns, F.timestamp_add("MINUTE", F.col("__s") * 15, as_ntz("__d")).alias(alias)
    )


def steps(df: DataFrame, start: Column | datetime, stop: Column | datetime, every: str, alias: str = "ts") -> DataFrame:
    """Rows of ``df`` repeated for each step from start to stop, both included."""
    lo = F.lit(start).cast(NTZ) if isinstance(start, datetime) else start
    hi = F.lit(stop).cast(NTZ) if isinstance(stop, datetime) else stop
    return df.withColumn(alias, F.explode(F.sequence(lo, hi, F.expr(f"interval {every}"))))


def _keys(df: DataFrame) -> list[str]:
    return list(df.columns)
