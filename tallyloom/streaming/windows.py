"""Windowed counts of event streams, closed by the declared watermark.

The state of an open window is one row per key, so a hot key costs one row and what
arrives for it is summed in the map tasks.  A window is dropped from the state once the watermark
has passed its end; rows that come later still are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.streaming.keyed_log import KeyedLog
from tallyloom.streaming.run import each_batch


def window_totals(
    events: DataFrame,
    size: str,
    keys: Sequence[str],
    totals: Mapping[str, Column],
    slide: str | None = None,
    time: str = "event_time",
) -> DataFrame:
    """``totals`` per window of ``size`` and key, with ``window_start`` and ``window_end``.

    ``events`` is a stream with a watermark on ``time`` or an ordinary table, for which the
    result is the same without the late rows.  ``slide`` makes overlapping windows.  Rows
    without a time are in no window.
    """
    window = F.window(time, size, slide) if slide else F.window(time, size)
    grouped = events.where(F.col(time).isNotNull()).groupBy(window.alias("window"), *keys).agg(*(c.alias(n) for n, c in totals.items()))
    return grouped.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *totals)


def window_table(path: str, totals: DataFrame, keys: Sequence[str]) -> KeyedLog:
    """The table that keeps the newest totals of every window and key; later batches replace earlier ones."""
    return KeyedLog(path, T.StructType(list(totals.schema)), ["window_start", *keys], [], by_arrival=True)


def keep_totals(totals: DataFrame, table: KeyedLog):
    """The writer that publishes, per batch, the windows whose totals changed; open windows are seen as they grow."""
    return each_batch(totals, table.append, mode="update")


def closed(windows: DataFrame, watermark: Column) -> DataFrame:
    """The windows that can no longer change."""
    return windows.where(F.col("window_end") <= watermark)
