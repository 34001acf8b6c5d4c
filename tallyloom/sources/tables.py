"""Tables to read: stored, streamed, literal and relational; names and places."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.contracts import DIMENSIONS, Table, apply_contract


def scan_table(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """The table as it stands, with the declared types."""
    return spark.read.schema(table.schema).parquet(path)


def stream_table(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None, **options: str) -> DataFrame:
    """The table as a stream of newly added files."""
    reader = spark.readStream.schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def values_rows(spark: SparkSession, rows: Iterable[tuple], table: Table) -> DataFrame:
    """Literal rows given as text or plain values, cast to the table."""
    texts = [tuple(None if v is None else str(v) for v in row) for row in rows]
    raw = T.StructType([T.StructField(name, T.StringType()) for name in table.columns])
    return apply_contract(spark.createDataFrame(texts, raw), table)


def read_dim(
    spark: SparkSession,
    name: str,
    path: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    split_on: str | None = None,
    bounds: tuple[str, str] | None = None,
    tasks: int = 16,
) -> DataFrame:
    """A relational dimension of ``contracts.DIMENSIONS``, from its snapshot or over JDBC.

    ``split_on`` with ``bounds`` reads a large table in ``tasks`` ranges at once.
    """
    table = DIMENSIONS[name]
    if path:
        return scan_table(spark, path, table)
    reader = spark.read.format("jdbc").options(**(jdbc or {})).option("dbtable", name)
    if split_on and bounds:
        reader = reader.options(
            partitionColumn=split_on, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=str(tasks)
        )
    return apply_contract(reader.load(), table)


def warehouse_path(root: str, database: str, table: str) -> str:
    """Where a table lies below a ``file://``, ``oss://`` or ``s3://`` root."""
    return f"{root.rstrip('/')}/{database}.db/{table}"


def object_store_settings(endpoint: str) -> dict[str, str]:
    """Session settings of an S3-style store; the credentials come from the environment."""
    prefix = "spark.hadoop.fs.s3a."
    settings = {f"{prefix}endpoint": endpoint, f"{prefix}impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}
    for option, variable in (("access.key", "AWS_ACCESS_KEY_ID"), ("secret.key", "AWS_SECRET_ACCESS_KEY")):
        if variable in os.environ:
            settings[prefix + option] = os.environ[variable]
    return settings


def table_ref(name: str) -> str:
    """The last part of ``catalog.database.table``, the name its view is registered under."""
    return name.replace("`", "").split(".")[-1]


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(table_ref(name))


def list_databases(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database)]


def list_columns(spark: SparkSession, table: str, database: str | None = None) -> list[tuple[str, str]]:
    full = f"{database}.{table}" if database else table
    return [(c.name, c.dataType) for c in spark.catalog.listColumns(full)]


def generate_orders(numbers: DataFrame, first_day: str = "2026-08-20") -> DataFrame:
    """One source order per row of ``numbers(seq)``.

    Amount and day are fixed functions of ``seq``, so that a retried task writes
    the same rows again.  Numbers are padded to at least 8 and 6 digits, never cut.
    """
    seq = F.col("seq")

    def padded(least: int) -> Column:
        digits = seq.cast("string")
        return F.lpad(digits, F.greatest(F.length(digits), F.lit(least)), F.lit("0"))

    return numbers.select(
        seq.alias("id"),
        F.concat(F.lit(f"DY{first_day.replace('-', '')}"), padded(8)).alias("order_id"),
        F.lit("DOUYIN").alias("platform_code"),
        F.lit("official").alias("shop_id"),
        F.concat(F.lit("buyer_"), padded(6)).alias("buyer_uid"),
        (F.lit(2999) + ((seq * 7919) % 500000).cast("decimal(20,0)") / F.lit(100))
        .cast("decimal(16,2)")
        .alias("total_amount"),
        F.when(seq % 10 == 0, "UNPAID").otherwise("PAID").alias("pay_status"),
        F.date_sub(F.lit(first_day).cast("date"), ((seq * 31) % 7).cast("int")).cast("timestamp").alias("create_time"),
    )
