"""Date and status filters of the analyst layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalars import compact_day, is_one_of


def filter_paid(df: DataFrame, paid: tuple[str, ...] | str, column: str = "pay_status") -> DataFrame:
    return df.where(is_one_of(column, paid))


def _as_of(df: DataFrame, as_of: str | Column | None, column: str) -> Column:
    """The day to count back from: the caller's, else the last day the table holds."""
    return df.agg(F.max(column)).scalar() if as_of is None else F.lit(as_of)


def filter_recent_days(
    df: DataFrame, days: int, as_of: str | Column | None = None, column: str = "stat_date"
) -> DataFrame:
    """Counted back from ``as_of`` (a day, or ``F.current_date()``), the last ``days`` days up to any day in the table, on a ``yyyy-MM-dd`` text column."""
    last = _as_of(df, as_of, column).cast("date")
    return df.where(F.col(column) >= F.date_format(F.date_sub(last, days - 1), "yyyy-MM-dd"))


# How questions name a period, with the unit and how many units it lies back.
PERIODS = {
    "今天": ("day", 0),
    "昨天": ("day", 1),
    "本周": ("week", 0),
    "上周": ("week", 1),
    "本月": ("month", 0),
    "上月": ("month", 1),
}


def period_range(name: str, as_of: str | Column) -> tuple[Column, Column]:
    """The first and the last day of a named period, seen from ``as_of``; weeks begin on Monday.

    A period that is not over ends with ``as_of``.
    """
    unit, back = PERIODS[name]
    day = (F.lit(as_of) if isinstance(as_of, str) else as_of).cast("date")
    start = day if unit == "day" else F.trunc(day, unit)

    def moved(n: int) -> Column:
        return F.add_months(start, -n) if unit == "month" else F.date_sub(start, n * (7 if unit == "week" else 1))

    return moved(back), F.date_sub(moved(back - 1), 1) if back else day


def filter_period(df: DataFrame, name: str, as_of: str | Column | None = None, column: str = "stat_date") -> DataFrame:
    """The days of a named period on a ``yyyy-MM-dd`` text column."""
    first, last = period_range(name, _as_of(df, as_of, column))
    return df.where(F.col(column).between(F.date_format(first, "yyyy-MM-dd"), F.date_format(last, "yyyy-MM-dd")))


def since_days(df: DataFrame, days: int, as_of: str, column: str) -> DataFrame:
    """The same window on a raw timestamp, which the Parquet scan can skip row groups by."""
    first = dt.date.fromisoformat(as_of) - dt.timedelta(days=days - 1)
    return df.where(F.col(column) >= F.lit(first.isoformat()).cast(df.schema[column].dataType))


def filter_dt_range(df: DataFrame, first: Column | str, last: Column | str, column: str = "dt") -> DataFrame:
    """A closed range on a ``yyyyMMdd`` text column; bounds may be dates or ``yyyy-MM-dd`` text."""
    low = compact_day(F.lit(first) if isinstance(first, str) else first)
    high = compact_day(F.lit(last) if isinstance(last, str) else last)
    return df.where(F.col(column).between(low, high))


def filter_single_day(df: DataFrame, day: str, column: str = "stat_date") -> DataFrame:
    return df.where(F.col(column) == day)
