"""Column expressions shared by the jobs.  All of them stay on the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = "yyyy-MM-dd"
COMPACT_DAY = "yyyyMMdd"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str, scale: int, precision: int = 16) -> Column:
    """``num / den`` as a decimal, rounded half up; NULL when ``den`` is zero."""
    quotient = col(num).cast(f"decimal({precision},{max(scale, 2)})") / F.nullif(col(den), F.lit(0))
    return quotient.cast(f"decimal({precision},{scale})")


def day_text(ts: Column | str) -> Column:
    return F.date_format(col(ts), DAY)


def compact_day(day: Column | str) -> Column:
    """``2026-07-20`` to ``20260720``."""
    return F.replace(col(day).cast("string"), F.lit("-"), F.lit(""))


def is_one_of(c: Column | str, values: tuple[str, ...] | str) -> Column:
    if isinstance(values, str):
        return col(c) == F.lit(values)
    return col(c).isin(*values)


def count_if(condition: Column) -> Column:
    """``SUM(CASE WHEN condition THEN 1 ELSE 0 END)``."""
    return F.sum(F.when(condition, 1).otherwise(0))


def sum_if(condition: Column, value: Column | str) -> Column:
    """``SUM(CASE WHEN condition THEN value ELSE 0 END)``."""
    return F.sum(F.when(condition, col(value)).otherwise(F.lit(0)))


def distinct_if(condition: Column, value: Column | str) -> Column:
    """``COUNT(DISTINCT CASE WHEN condition THEN value END)``."""
    return F.count_distinct(F.when(condition, col(value)))


def strip(text: Column | str) -> Column:
    """Without white space at both ends, line breaks and tabs included."""
    return F.regexp_replace(col(text), r"^\s+|\s+$", "")


def category_level(path: Column | str, level: int) -> Column:
    """Part ``level`` (1 is the top) of a ``a>b>c>d`` path, NULL when absent."""
    return strip(F.get(F.split(col(path), ">"), F.lit(level - 1)))


def after_last(text: Column | str, marker: str) -> Column:
    """What follows the last ``marker``; the whole text when there is none."""
    return strip(F.substring_index(col(text), marker, -1))


def money_text(amount: Column | str) -> Column:
    """Two decimals with thousands separators."""
    return F.format_number(col(amount), 2)


def list_items(text: Column | str) -> Column:
    """A comma list to an array of trimmed, non-empty items; empty for NULL."""
    parts = F.transform(F.split(F.coalesce(col(text), F.lit("")), ","), strip)
    return F.filter(parts, lambda item: item != "")


def words(text: Column | str) -> Column:
    """Distinct lower-case words of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(col(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two numeric arrays; NULL when either has no length."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    a, b = a.cast("array<double>"), b.cast("array<double>")
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
