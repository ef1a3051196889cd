"""Calendar expressions on zone-less timestamps.

Everything goes through DATE, so that the session time zone never matters
(``date_trunc`` would return a zoned timestamp).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def day(ts: str | Column) -> Column:
    return _c(ts).cast("date")


def month_start(ts: str | Column) -> Column:
    return F.trunc(day(ts), "month")


def week_start(ts: str | Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(day(ts), "week")


def as_ntz(d: str | Column) -> Column:
    return _c(d).cast(NTZ)


def quarter_start(ts: str | Column) -> Column:
    """Start of the quarter hour (15-minute bucket)."""
    c = _c(ts)
    minutes = F.hour(c) * 60 + F.floor(F.minute(c) / 15).cast("int") * 15
    return F.timestamp_add("MINUTE", minutes.cast("int"), as_ntz(day(c)))


def big(c: Column) -> Column:
    return c.cast("bigint")


def year(c: str | Column) -> Column:
    return big(F.year(_c(c)))


def month(c: str | Column) -> Column:
    return big(F.month(_c(c)))


def hour(c: str | Column) -> Column:
    return big(F.hour(_c(c)))


def iso_week(c: str | Column) -> Column:
    return big(F.weekofyear(_c(c)))


def date_lit(d: date) -> Column:
    return F.lit(d).cast("date")


def local_to_utc(ts: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)


def utc_to_local(ts: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
