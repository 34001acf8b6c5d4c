"""Writing and reading warehouse tables as Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.contracts import Table, apply_contract
from tallyloom.session import exists, move


def layout(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather the rows of an output partition for few, well-filled files.

    Adaptive execution splits a partition that turns out large over several tasks
    and merges small ones, so neither a hot day nor many small days hurt.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def overwrite_partitions(df: DataFrame, path: str, table: Table, max_rows: int = 20_000_000) -> None:
    """Replace the partitions that ``df`` holds; the others stay."""
    rows = layout(apply_contract(df, table), table.partition_by)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_rows)
    writer.partitionBy(*table.partition_by).parquet(path)


def append_rows(df: DataFrame, path: str, table: Table) -> None:
    writer = layout(apply_contract(df, table), table.partition_by).write.mode("append")
    if table.partition_by:
        writer = writer.partitionBy(*table.partition_by)
    writer.parquet(path)


def replace_table(df: DataFrame, path: str, table: Table) -> None:
    """Write a new copy of a table; ``path`` must be a new folder when ``df`` reads the old copy."""
    writer = layout(apply_contract(df, table, check_keys=True), table.partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
    if table.partition_by:
        writer = writer.partitionBy(*table.partition_by)
    writer.parquet(path)


def write_once(df: DataFrame | Sequence[DataFrame], path: str, partition_by: Sequence[str] = ()) -> None:
    """Write the folder ``path`` so that readers see it whole or not at all; one that is there already stays as it is.

    The rows go to a hidden folder beside it, which one rename puts in place.  A
    replay therefore leaves no gap: it finds the folder complete, or nothing.  Several
    frames are written one after the other, so that only one of them takes room for its shuffles.
    """
    frames = [df] if isinstance(df, DataFrame) else list(df)
    spark = frames[0].sparkSession
    if exists(spark, path):
        return
    parent, _ = path.rstrip("/").rsplit("/", 1)
    attempt = f"{parent}/_attempt-{uuid.uuid4().hex}"
    for frame in frames:
        writer = frame.write.mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(attempt)
    move(spark, attempt, path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table with the declared types; partition values keep theirs instead of being guessed."""
    return spark.read.schema(schema).parquet(path)


def init_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def create_table(spark: SparkSession, database: str, table: Table, path: str) -> None:
    """Declare an external Parquet table with the contract's columns, once."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    parts = f" PARTITIONED BY ({', '.join(table.partition_by)})" if table.partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{table.name}` ({columns}) USING parquet{parts} LOCATION '{path}'")


def drop_table(spark: SparkSession, database: str, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")


def result_rows(df: DataFrame, cap: int) -> dict:
    """A small result for a caller outside Spark: columns, at most ``cap`` rows, and whether there were more."""
    rows = [row.asDict(recursive=True) for row in df.limit(cap + 1).collect()]
    return {"columns": df.columns, "data": rows[:cap], "row_count": len(rows[:cap]), "truncated": len(rows) > cap}
