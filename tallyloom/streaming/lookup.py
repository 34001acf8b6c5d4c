"""Facts of a stream with a dimension that changes while the stream runs.

Every batch reads the dimension anew, as it stands when the batch is first processed.  The
version it saw is noted before anything is written, so a batch that is replayed sees the
same version again, whatever has been added since.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.operators.joins import join_left_dim
from tallyloom.session import exists
from tallyloom.sinks.tables import write_once
from tallyloom.streaming.keyed_log import KeyedLog


class LookupJoin:
    """The ``foreachBatch`` step of a stream-to-table look-up; facts without a match keep NULLs."""

    def __init__(self, dim: KeyedLog, key: str, columns: Sequence[str], path: str):
        self.dim, self.key, self.columns, self.path = dim, key, list(columns), path.rstrip("/")

    def seen(self, spark: SparkSession, batch_id: int) -> int:
        """The last batch of the dimension that this batch of facts sees."""
        note = f"{self.path}/seen/batch={batch_id}"
        if not exists(spark, note):
            last = self.dim.last_batch(spark)
            write_once(spark.createDataFrame([(last,)], "version long").coalesce(1), note)
        return spark.read.schema("version long").parquet(note).first()[0]

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dim = self.dim.current(spark, before=self.seen(spark, batch_id) + 1)
        write_once(join_left_dim(batch, dim, self.key, self.columns), f"{self.path}/rows/batch={batch_id}")

    def result(self, spark: SparkSession, facts: T.StructType) -> DataFrame:
        """All facts so far, whose columns are ``facts``, with the looked-up columns."""
        schema = T.StructType([*facts, *(self.dim.schema[c] for c in self.columns)])
        return spark.read.schema(schema).parquet(f"{self.path}/rows").select(*schema.names)
