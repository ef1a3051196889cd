"""Looking up a step function that is the same for every site."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def step_lookup(left: DataFrame, left_key: str, steps: DataFrame, step_key: str, values: Sequence[str]) -> DataFrame:
    """Newest step with ``step <= left`` for coarse keys (years, months), of which a calendar bounds the number.

    All steps become one row with an array, in which each left row looks its step up: the left side is evaluated once
    and not moved.  Of steps with equal keys the one with the largest values counts; a step or a left row without a key
    matches nothing.
    """
    names = [F.col(v) for v in values]
    distinct = (
        steps.where(F.col(step_key).isNotNull())
        .groupBy(F.col(step_key).alias("__s"))
        .agg(F.max(F.struct(*names)).alias("__hit"))
    )
    # one row on the right: an aggregate without grouping
    listed = distinct.agg(F.array_sort(F.collect_list(F.struct("__s", "__hit"))).alias("__steps"))
    before = F.filter("__steps", lambda x: x["__s"] <= F.col(left_key))
    found = left.crossJoin(listed).withColumn("__hit", F.try_element_at(before, F.lit(-1))["__hit"])
    return found.select(left_key, *[F.col(c) for c in left.columns if c != left_key], *[F.col("__hit")[v].alias(v) for v in values])
