"""Change rows: decoding, encoding and folding into a keyed table.

A change row has ``op`` (``c`` or ``r`` create, ``u`` update, ``d`` delete), the
row's columns, and columns that tell the order of changes.  An update may arrive
as a delete followed by a create; only the order decides, never the op.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.keyed import latest_per_key
from tallyloom.sources.events import SQL_CLOCK, decode

CREATED = ("c", "r")


def decode_changes(df: DataFrame, row: T.StructType, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``{"before": …, "after": …, "op": …}`` texts to rows: ``op`` and the row after the change, or before a delete."""
    envelope = T.StructType([T.StructField("before", row), T.StructField("after", row), T.StructField("op", T.StringType())])
    changes = decode(df, envelope, SQL_CLOCK, value, keep).where("op IN ('c', 'r', 'u', 'd')")
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return changes.select(*keep, "op", image.alias("_row")).where("_row IS NOT NULL").select(*keep, "op", "_row.*")


def encode_changes(changes: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Rows with an ``op`` to message ``key`` and ``value``; an update is written as the row it leads to."""

    def shown(c: str) -> Column:
        kind = changes.schema[c].dataType
        text = F.date_format(c, "yyyy-MM-dd HH:mm:ss") if isinstance(kind, T.TimestampType) else F.col(c)
        return text.alias(c)

    row = F.struct(*[shown(c) for c in columns])
    gone = F.col("op") == "d"
    body = F.struct(
        F.when(gone, row).alias("before"),
        F.when(~gone, row).alias("after"),
        F.when(gone, "d").otherwise("c").alias("op"),
    )
    return changes.select(F.col(key).cast("string").alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def cdc_apply(target: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The keyed table after the changes: the last change of a key wins and a delete removes it."""
    last = latest_per_key(changes, keys, order_by)
    untouched = target.join(last.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(last.where("op <> 'd'").select(*target.columns))


def snapshot_then_changes(
    snapshot: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """A full snapshot (one row per key) followed by ordered changes, folded to the current rows.

    Changes always win over the snapshot, so only they are ranked.
    """
    missing = {c: F.lit(None).cast(changes.schema[c].dataType) for c in order_by if c not in snapshot.columns}
    return cdc_apply(snapshot.withColumns(missing) if missing else snapshot, changes, keys, order_by)
