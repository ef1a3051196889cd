"""Numeric rules: exact decimal sums first, one division in double afterwards.

Sums of DECIMAL columns are exact, so they do not depend on the order in which
partitions are merged.  Only the final value becomes a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POWER = "decimal(8,3)"
#: what a bare NUMERIC means
NUMERIC = "decimal(18,3)"


def zero(dtype: str = POWER) -> Column:
    return F.lit(0).cast(dtype)


def or_zero(col: str | Column) -> Column:
    """NULL counts as no power."""
    return F.coalesce(_col(col), zero(POWER))


def own_use_sum(production: str = "production", export: str = "export") -> Column:
    """Sum of the power produced and not exported, a row counting 0 where more is exported.

    Written as the difference of two plain sums: Spark adds up DECIMAL(8,3) columns
    as integers, but no longer does so for a wider computed value.
    """
    kept = F.col(production) > F.col(export)
    none = zero(POWER)
    return F.sum(F.when(kept, F.col(production)).otherwise(none)) - F.sum(F.when(kept, F.col(export)).otherwise(none))


def kwh(summed: Column) -> Column:
    """Energy of a sum of quarter-hour mean powers in W."""
    return summed.cast("double") / F.lit(4.0) / F.lit(1000.0)


def energy(col: str | Column) -> Column:
    """Energy in kWh of a group's power column, as an aggregate."""
    return kwh(F.sum(_col(col)))


def mean(col: str | Column) -> Column:
    """Average of a decimal as a double: exact sum, one division."""
    c = _col(col)
    return F.sum(c).cast("double") / F.count(c)


def ratio(total: Column, count: Column) -> Column:
    """An exact total over a count, as a double."""
    return total.cast("double") / count


def half_away(x: Column, digits: int = 0) -> Column:
    """Round a double half away from zero on its scaled binary value.

    Spark's ``round(x, n)`` works on the shortest decimal text of ``x`` and so
    turns 1.005 into 1.01; scaling first keeps the value the double really has.
    """
    if digits == 0:
        return F.round(x.cast("double"))
    factor = F.lit(float(10**digits))
    return F.round(x.cast("double") * factor) / factor


def half_even_int(x: Column) -> Column:
    """Double to integer, ties to even (Spark's own cast truncates)."""
    return F.rint(x).cast("int")


def percent(part: Column, whole: Column) -> Column:
    """part of whole in percent with two digits, at most 100."""
    return F.least(half_away(part / whole * F.lit(100.0), 2), F.lit(100.0))


def guarded_percent(part: Column, whole: Column, guard: Column | None = None) -> Column:
    """Like :func:`percent`, 0 where the guard (default: whole) is 0 or NULL."""
    g = whole if guard is None else guard
    return F.when(F.coalesce(g, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(percent(part, whole))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
