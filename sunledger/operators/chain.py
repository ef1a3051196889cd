"""Unbroken chains of validity periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unbroken_chain(
    df: DataFrame, by: Sequence[str], payload: Sequence[str], start: str = "valid_from", end: str = "valid_until"
) -> DataFrame:
    """Keep the periods reachable from the first one, each starting the day after its predecessor ends.

    A period begins a chain if no *closed* period of its group starts earlier.
    Walking the periods in order needs to remember one thing, the date the next
    link must start on, so a fold over the sorted list is enough; overlapping
    periods, which a ``lag`` over neighbours would trip on, are handled.

    (group, start) is unique, so a group holds at most one period per calendar
    day; in practice it is a few dozen price changes.
    """
    item = F.struct(F.col(start), F.col(end), *[F.col(c) for c in payload])
    folded = df.groupBy(*by).agg(F.array_sort(F.collect_list(item)).alias("__all"))
    periods = folded.select(*by, "__all")
    empty = F.filter("__all", lambda x: F.lit(False))
    no_date = F.lit(None).cast("date")
    walked = F.aggregate(
        "__all",
        F.struct(no_date.alias("due"), F.lit(False).alias("closed"), empty.alias("kept")),
        lambda acc, x: F.struct(
            F.when(_linked(acc, x, start), F.coalesce(F.date_add(x[end], 1), acc["due"]))
            .otherwise(acc["due"])
            .alias("due"),
            (acc["closed"] | x[end].isNotNull()).alias("closed"),
            F.when(_linked(acc, x, start), F.concat(acc["kept"], F.array(x))).otherwise(acc["kept"]).alias("kept"),
        ),
        lambda acc: acc["kept"],
    )
    return periods.select(*by, F.inline(walked))


def _linked(acc, x, start):
    return ~acc["closed"] | F.coalesce(x[start] == acc["due"], F.lit(False))
