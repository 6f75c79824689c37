"""Calendar and elapsed-time expressions.

All of them work on TIMESTAMP_NTZ (and TIMESTAMP) and compile to JVM expressions.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# English weekday names, in the order Spark's dayofweek() counts (1 = Sunday).
WEEKDAYS_FROM_SUNDAY = (
    "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
)
WEEKDAYS_FROM_MONDAY = WEEKDAYS_FROM_SUNDAY[1:] + WEEKDAYS_FROM_SUNDAY[:1]


def lenient_timestamp(value: Column | str) -> Column:
    """Naive timestamp, or null where the text cannot be read as one."""
    return F.col(value).try_cast("timestamp_ntz") if isinstance(value, str) else value.try_cast(
        "timestamp_ntz"
    )


def parse_timestamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: lenient_timestamp(c) for c in columns})


def weekday_name(ts: Column) -> Column:
    """Full English name. No formatter and no locale: one array lookup per row."""
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS_FROM_SUNDAY]), F.dayofweek(ts))


def whole_days(later: Column, earlier: Column) -> Column:
    """Completed 24-hour periods from ``earlier`` to ``later``, rounded down.

    The count of midnights is one too high whenever adding it to ``earlier`` overshoots
    ``later``; this also gives -1 for "five hours before". Never passes through a time zone.
    """
    midnights = F.datediff(later, earlier)
    return midnights - (F.timestamp_add("DAY", midnights, earlier) > later).cast("int")


def flag(condition: Column) -> Column:
    """1/0 with null counted as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def first_of_month(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def month_ahead(year: Column, month: Column, ahead: Column) -> Column:
    """First day of the month ``ahead`` months later; carries the year."""
    return F.add_months(first_of_month(year, month), ahead)


def quarter_of(month: Column) -> Column:
    return (F.floor((month - 1) / 3) + 1).cast("int")


def season_columns(month: Column) -> dict[str, Column]:
    """Quarter, fourth-quarter flag and the month's position on the yearly circle."""
    angle = F.lit(2 * math.pi) * month / 12
    return {
        "quarter": quarter_of(month),
        "is_q4": (quarter_of(month) == 4).cast("int"),
        "month_sin": F.sin(angle),
        "month_cos": F.cos(angle),
    }


def month_label(day: Column) -> Column:
    """For example ``March 2018``."""
    return F.date_format(day, "MMMM yyyy")
