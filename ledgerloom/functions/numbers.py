"""Numeric expressions: ratios, shares, clamps and the two rounding rules."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double; null when the denominator is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def share_of_total(value: Column) -> Column:
    """Percent of the column total. For aggregated frames only: the window has one partition."""
    return percent(value, F.sum(value).over(Window.partitionBy()))


def sql_round(value: Column, digits: int) -> Column:
    """Half away from zero, as SQL engines round."""
    return F.round(value, digits)


def even_round(value: Column, digits: int) -> Column:
    """Half to even, as Python and pandas round."""
    return F.bround(value, digits)


def millions(value: Column) -> Column:
    return value / F.lit(1e6)


def at_least_zero(value: Column) -> Column:
    return F.greatest(F.lit(0), value)


def clip_above(value: Column, limit: Column | float) -> Column:
    """Upper clamp; null stays null (``least`` alone would return the limit)."""
    top = limit if isinstance(limit, Column) else F.lit(limit)
    return F.when(value > top, top).otherwise(value)
