"""Pivots with known columns, and dropping the empty ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTHS = list(range(1, 13))


def pivot_columns(
    df: DataFrame, keys: Sequence[str], on: str, values: Sequence[object], agg: Callable[[], Column]
) -> DataFrame:
    """Turn the listed values of ``on`` into columns; naming them saves Spark a job to find them."""
    return df.groupBy(*keys).pivot(on, list(values)).agg(agg())


def month_columns(df: DataFrame, keys: Sequence[str], on: str, agg: Callable[[], Column]) -> DataFrame:
    return pivot_columns(df, keys, on, MONTHS, agg)


def drop_empty_columns(df: DataFrame, keep: Sequence[str], rename: Mapping[str, str] | None = None) -> DataFrame:
    """Drop columns that hold only NULLs, then rename the rest.

    One aggregate over the frame decides; its single row of counts is all that
    reaches the driver.
    """
    rest = [c for c in df.columns if c not in keep]
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in rest]).first()
    names = rename or {}
    chosen = [*keep, *[c for c in rest if counts[c] > 0]]
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in chosen])
