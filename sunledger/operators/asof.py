"""As-of joins.

Spark has no ASOF syntax.  Both sides are put into one tagged union, and a
window carries the newest right row (as a struct, so that NULLs inside a matched
row survive) over the left rows.  That costs one shuffle and one sort whatever
the number of right tables, and never broadcasts anything.

Two large sides get a time ``bucket`` in the partition key, so that one busy site
spreads over many tasks.  A bucket needs the newest right row from before its
start: one carry row for each bucket that the left side has, so a stray left key far off
costs one row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_KEY, _SRC, _BUCKET, _RIGHT = "__key", "__src", "__bucket", "__right"


@dataclass(frozen=True)
class Match:
    """One right side: rows with unique (by, key)."""

    right: DataFrame
    key: Column
    #: output name -> column of the right side
    columns: dict[str, str] = field(default_factory=dict)


def asof_join(
    left: DataFrame,
    left_key: Column,
    matches: Sequence[Match],
    *,
    by: Sequence[str],
    forward: bool = False,
    inner: bool = False,
    bucket: Callable[[Column], Column] | None = None,
    buckets: DataFrame | None = None,
) -> DataFrame:
    """Add to each left row the nearest right row with ``right <= left``.

    ``forward`` turns to the nearest with ``right >= left``.  ``inner`` drops left
    rows without any partner in the first match.  ``bucket`` maps a key to an
    integer that grows with it; ``buckets`` may give the (by, bucket) pairs of the left
    side as its columns in that order, otherwise one aggregate over the left keys finds
    them.
    """
    payload = [f"__r{i}" for i in range(len(matches))]
    left_cols = left.columns
    sides = []
    for i, m in enumerate(matches):
        row = F.struct(*[F.col(src).alias(dst) for dst, src in m.columns.items()])
        side = m.right.select(*by, m.key.alias(_KEY), F.lit(i).alias(_SRC), row.alias(payload[i])).where(
            F.col(_KEY).isNotNull()
        )
        sides.append(side)

    parts = list(by)
    if bucket is not None:
        parts.append(_BUCKET)
        own = left.select(*by, bucket(left_key).alias(_BUCKET)) if buckets is None else buckets.toDF(*by, _BUCKET)
        places = own.where(F.col(_BUCKET).isNotNull()).distinct()
        sides = [_with_carry(s, p, by, bucket, places, forward) for s, p in zip(sides, payload, strict=True)]

    rights = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), sides)
    held = [c for c in (_KEY, _SRC, _BUCKET, *payload) if c in rights.columns]
    both = left.unionByName(rights.select(*by, F.struct(*held).alias(_RIGHT)), allowMissingColumns=True)
    # A left row is shuffled as it is; what it is ordered and dealt by follows from it, and is added afterwards.
    mine, right = F.col(_RIGHT).isNull(), F.col(_RIGHT)
    added = {_KEY: F.when(mine, left_key).otherwise(right[_KEY]), _SRC: F.when(mine, len(matches)).otherwise(right[_SRC])}
    if bucket is not None:
        added[_BUCKET] = F.when(mine, bucket(left_key)).otherwise(right[_BUCKET])
        # A fixed number: left rows compress well, so AQE would pack more of them into a task than it can sort in memory.
        both = both.repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by, added[_BUCKET])
    both = both.select(*left_cols, *[c.alias(n) for n, c in added.items()], *[right[p].alias(p) for p in payload])

    # Equal keys match, hence right rows come first within a key.
    order = [F.col(_KEY).desc() if forward else F.col(_KEY).asc(), F.col(_SRC).asc()]
    w = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.select(
        *left_cols, _SRC, *[F.last(p, ignorenulls=True).over(w).alias(p) for p in payload]
    ).where(F.col(_SRC) == len(matches))
    if inner:
        carried = carried.where(F.col(payload[0]).isNotNull())
    out = [F.col(c) for c in left_cols]
    for p, m in zip(payload, matches, strict=True):
        out += [F.col(p)[dst].alias(dst) for dst in m.columns]
    return carried.select(*out)


def _with_carry(
    side: DataFrame,
    payload: str,
    by: Sequence[str],
    bucket: Callable[[Column], Column],
    places: DataFrame,
    forward: bool,
) -> DataFrame:
    """Right rows plus, for each bucket of ``places``, the last row before it.

    Per bucket only its last row matters, so the window runs over buckets, not over rows.
    """
    side = side.withColumn(_BUCKET, bucket(F.col(_KEY)))
    nearest = (F.min_by if forward else F.max_by)(payload, _KEY)
    ends = side.groupBy(*by, _BUCKET).agg(
        F.struct((F.min if forward else F.max)(_KEY).alias(_KEY), F.first(_SRC).alias(_SRC), nearest.alias(payload)).alias("__end")
    )
    both = ends.withColumn("__place", F.lit(0)).unionByName(places.withColumn("__place", F.lit(1)), allowMissingColumns=True)
    order = [F.col(_BUCKET).desc() if forward else F.col(_BUCKET).asc(), F.col("__place").desc()]
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = both.select(*by, _BUCKET, "__place", F.last("__end", ignorenulls=True).over(before).alias("__end"))
    carry = carry.where("__place = 1 and __end is not null")
    return side.unionByName(carry.select(*by, *[F.col("__end")[c].alias(c) for c in (_KEY, _SRC, payload)], _BUCKET))


def month_index(ts: Column) -> Column:
    """Months since year 0, the usual bucket of quarter-hour series."""
    return (F.year(ts) * 12 + F.month(ts)).cast("int")
