"""Calendar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def on_day(ts: Column) -> Column:
    """The calendar day of a timestamp."""
    return F.to_date(ts)


def days_between(later: Column, earlier: Column) -> Column:
    """Whole calendar days between two timestamps, the time of day left out."""
    return F.datediff(later, earlier)


def month_before(as_of: dt.date | str | Column | None = None) -> tuple[Column, Column]:
    """First day of the month before `as_of` (today if None) and first day after it.

    Both ends fold to literals, so a filter on them reaches the file scan.
    """
    if as_of is None:
        day = F.current_date()
    elif isinstance(as_of, Column):
        day = as_of
    else:
        day = F.to_date(F.lit(str(as_of)[:10]))
    start = F.trunc(F.add_months(day, -1), "MM")
    return start, F.add_months(start, 1)


def calendar(dates: DataFrame, column: str) -> DataFrame:
    """One row per distinct day with full month and weekday names.

    The distinct is combined before the shuffle, so a day that holds most rows
    travels once per task.
    """
    return (
        dates.select(F.to_date(column).alias("Date"))
        .where(F.col("Date").isNotNull())
        .distinct()
        .select(
            "Date",
            F.date_format("Date", "MMMM").alias("MonthName"),
            F.date_format("Date", "EEEE").alias("WeekDayName"),
            F.dayofmonth("Date").alias("Day"),
            F.year("Date").alias("Year"),
        )
    )
