"""Ranks that keep every row without sorting a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import stored


def rank_within(df: DataFrame, group: str, value: str, tie: str, out: str = "rank_no") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY group ORDER BY value DESC, tie)`` for groups of any size.

    The rows are range-partitioned by the whole order and written once with the
    number of their range.  Ranges are of even size whatever the groups or ties are,
    so a row's rank is its place in its range plus the rows of the group's earlier
    ranges, and only one count per group and range meets in one place.  NULL is a group of
    its own.
    """
    keyed = df.withColumn("_group", F.col(group))
    ordered = keyed.repartitionByRange("_group", F.desc_nulls_last(value), F.asc(tie))
    placed = stored(ordered.withColumn("_range", F.spark_partition_id()), "ranked")
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_group", "_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(F.col("_group").alias("_its"), F.col("_range").alias("_place"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_group", "_range").orderBy(F.desc_nulls_last(value), F.asc(tie))
    return (
        placed.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, F.col("_group").eqNullSafe(F.col("_its")) & (F.col("_range") == F.col("_place")))
        .withColumn(out, (F.col("_before") + F.col("_inside")).cast("int"))
        .drop("_group", "_range", "_its", "_place", "_inside", "_before")
    )


def first_within(df: DataFrame, group: str, value: str, tie: str, n: int = 1, out: str = "rank_no") -> DataFrame:
    """The first ``n`` rows of each group.  Map tasks keep ``n`` candidates per group before the shuffle."""
    order = Window.partitionBy(group).orderBy(F.desc_nulls_last(value), F.asc(tie))
    return df.withColumn(out, F.row_number().over(order).cast("int")).where(F.col(out) <= n)


def top(df: DataFrame, n: int | None, *order: Column) -> DataFrame:
    """The first ``n`` rows of a total order, kept as partial tops per task; all rows in order without ``n``."""
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)
