"""As-of joins by intervals, for a right side that is small next to the left one.

Each right row holds from its key up to the next one's (``lead`` over the right side alone).  Cut at the borders of a time
``bucket``, these intervals meet the left rows by an equi join on (by, bucket) with a range beside it, and rows beyond the
outermost key take that row by an equi join on ``by``.  So the left side is read once and not sorted for it: Spark sends
the right side around as long as it is small, and shuffles both by (by, bucket) otherwise.  The outermost rows, one for each
``by``, are always sent around, so that no join moves the left side by ``by`` alone, and several joins over the same
left key and bucket move it once.  ``asof_join`` is the other form, for two large sides and for several right ones.

A gap of the right side costs a row for each bucket in it, and a left row looks at all intervals of its bucket: take a bucket
wider than its keys are apart, but not by much.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.operators.asof import Match

_FROM, _UNTIL, _ROW, _END = "__from", "__until", "__row", "__end"


@dataclass(frozen=True)
class Intervals:
    """A right side cut into intervals; several joins may share it."""

    pieces: DataFrame
    outermost: DataFrame
    by: tuple[str, ...]
    bucket: Callable[[Column], Column]
    forward: bool


def intervals(match: Match, *, by: Sequence[str], bucket: Callable[[Column], Column], forward: bool = False, sent: bool = True) -> Intervals:
    """``match`` as intervals: a row holds for left keys from its own on, with ``forward`` for those up to its own.

    ``bucket`` maps a key to an integer that grows with it.  Rows without key match nothing.  With ``sent`` False both sides are
    shuffled however small the right one looks: for a left side that is the smaller one.
    """
    row = F.struct(*[F.col(src).alias(dst) for dst, src in match.columns.items()]).alias(_ROW)
    side = match.right.select(*by, match.key.alias(_FROM), row).where(F.col(_FROM).isNotNull())
    order = Window.partitionBy(*by).orderBy(F.col(_FROM).desc() if forward else F.col(_FROM))
    cut = side.withColumn(_UNTIL, F.lead(_FROM).over(order))
    own, last = bucket(F.col(_FROM)), bucket(F.coalesce(_UNTIL, _FROM))
    buckets = F.explode(F.sequence(last, own) if forward else F.sequence(own, last))
    # names of their own, as several joins may share them
    pieces = cut.select(*[F.col(c).alias(f"__{c}") for c in by], buckets.alias("__piece"), _FROM, _UNTIL, _ROW)
    if not sent:
        pieces = pieces.hint("merge")
    outermost = cut.where(F.col(_UNTIL).isNull()).select(*[F.col(c).alias(f"__{c}") for c in by], F.col(_FROM).alias(_END), F.col(_ROW).alias("__beyond"))
    return Intervals(pieces, outermost, tuple(by), bucket, forward)


def interval_join(left: DataFrame, left_key: Column, right: Intervals, columns: Sequence[str], *, inner: bool = False) -> DataFrame:
    """Add to each left row the ``columns`` of the nearest right row, as ``asof_join`` does.

    A left row without key or without a partner has NULL there; ``inner`` drops it.
    """
    # Not columns of their own: Spark then knows the left side to be dealt by the bucket of its key also after this join.
    key, since, until = left_key, F.col(_FROM), F.col(_UNTIL)
    if right.forward:
        holds = (key <= since) & (until.isNull() | (key > until))
        beyond = key <= F.col(_END)
    else:
        holds = (key >= since) & (until.isNull() | (key < until))
        beyond = key >= F.col(_END)
    same = [F.col(c) == F.col(f"__{c}") for c in right.by]
    met = left.join(right.pieces, [*same, right.bucket(key) == F.col("__piece"), holds], "left").drop(*[f"__{c}" for c in right.by])
    met = met.join(F.broadcast(right.outermost), same, "left")
    met = met.withColumn(_ROW, F.coalesce(F.col(_ROW), F.when(beyond, F.col("__beyond"))))
    if inner:
        met = met.where(F.col(_ROW).isNotNull())
    return met.select(*left.columns, *[F.col(_ROW)[c].alias(c) for c in columns])


def day_index(ts: Column) -> Column:
    """Days since 1970."""
    return F.unix_date(ts.cast("date"))


def hour_index(ts: Column) -> Column:
    """Hours since 1970."""
    return F.unix_date(ts.cast("date")) * 24 + F.hour(ts)
