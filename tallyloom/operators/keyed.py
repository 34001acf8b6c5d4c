"""Operators on tables with a primary key.

All of them shuffle on the key only and rank at most one row per key: the plan
keeps one candidate per key in each map task before the exchange, so a key that
holds a large share of the rows never travels whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import released_shuffles, stored


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The last row of each key.  ``order_by`` goes from oldest to newest and should be total."""
    newest_first = [F.desc_nulls_last(c) if isinstance(c, str) else c.desc_nulls_last() for c in order_by]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def upsert(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str], keys_first: bool = False
) -> DataFrame:
    """Merge by key: every incoming key replaces the target's row; the last incoming row wins.

    The target is read once and never ranked: it is keyed already.  When the
    incoming side is small the anti join is a broadcast and the target does not move.  The
    join needs no more than the incoming keys, which are not ranked for it.

    ``keys_first`` is for incoming rows that replace most of a large target.  The keys that stay are then
    found from the keys of both sides and stored; where these are few the target does not move either.
    """
    fresh = latest_per_key(incoming, keys, order_by)
    if keys_first:
        kept = _rows_of(target, _staying(target, incoming, keys), keys)
    else:
        kept = target.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.unionByName(fresh.select(*target.columns))


def _staying(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target's keys that no incoming row has, keys with a NULL among them, as a stored table."""
    with released_shuffles(target.sparkSession):
        return stored(target.select(*keys).join(incoming.select(*keys), list(keys), "left_anti"), "staying")


def _rows_of(target: DataFrame, some: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``target`` with a key in ``some``, where NULL is a key like any other."""
    named = some.select(*(F.col(k).alias(f"_stays_{i}") for i, k in enumerate(keys)))
    same = [F.col(k).eqNullSafe(F.col(f"_stays_{i}")) for i, k in enumerate(keys)]
    return target.join(named, same, "left_semi")


def insert_if_absent(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the incoming rows whose key the target does not hold yet."""
    one_each = latest_per_key(incoming, keys, [c for c in incoming.columns if c not in keys] or list(keys))
    return target.unionByName(one_each.join(target.select(*keys), list(keys), "left_anti").select(*target.columns))


def update_by_key(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str], order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """Set ``columns`` of the rows named in ``changes``; a target row stays one row.

    Where ``changes`` repeats a key, the last row by ``order_by`` and then by the set
    values counts.  A NULL in ``changes`` is a value like any other and overwrites.  The
    ranking and the join share one exchange by key.
    """
    last = latest_per_key(changes, keys, [*order_by, *columns])
    marked = last.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = target.join(marked, list(keys), "left")
    picked = [
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in target.columns
    ]
    return joined.select(*picked)


def delete_by_key(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(gone.select(*keys), list(keys), "left_anti")


def add_missing_column(df: DataFrame, name: str, default: Column) -> DataFrame:
    """Add a column with a default unless the table has it already."""
    return df if name in df.columns else df.withColumn(name, default)


def union_evolved(old: DataFrame, new: DataFrame, name: str, default: Column) -> DataFrame:
    """Rows written before and after a column was added, with the default filled in."""
    both = old.unionByName(new, allowMissingColumns=True)
    return both.withColumn(name, F.coalesce(F.col(name), default))


def drop_null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))
