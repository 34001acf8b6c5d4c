"""A keyed table fed by micro-batches.

Each micro-batch is written to a folder named after its id, one row per key.  The folder
appears whole, by a rename, and a replayed batch finds it there, so writing is exactly
once and a reader never misses a batch.  Writing never rewrites older data; reading keeps
the last row of each key.  ``fold`` merges the batches so far into a new table, which keeps reads short over time.

Batches may be partitioned, by day or by month.  A batch then looks for the rows it replaces
among the files of its own partitions only, however long the history has become.  Where these
are large it looks through some of them at a time (``steps``), which bounds what is shuffled at once.

Batch ids count anew for every query (a query with a new checkpoint is another one), so a
table belongs to the query that first wrote to it; another one is refused and goes on
from a ``fold`` instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.keyed import latest_per_key
from tallyloom.session import exists, folders, stored_bytes
from tallyloom.sinks.tables import layout, write_once

PART = "_part"
NO_PART = "__HIVE_DEFAULT_PARTITION__"
STEP_BYTES = 4 << 30  # of stored rows that one step looks through; shuffled, they take about three times the room


def of_parts(parts: Sequence[str | None]) -> Column:
    """Whether a row is in one of ``parts``, as a condition that picks folders."""
    known = F.col(PART).isin(*[p for p in parts if p is not None])
    return known | F.col(PART).isNull() if None in parts else known


class KeyedLog:
    def __init__(
        self,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        order_by: Sequence[str],
        by_arrival: bool = False,
        part: str | None = None,
        gather: bool = True,
    ):
        """``order_by`` goes from old to new; leave it empty when a batch holds one row per key.

        ``by_arrival`` lets a later batch win whatever its order says.  ``part`` is the
        text that batches are partitioned by; all rows of a key must have the same.  ``gather``
        moves a batch's rows to their partition for few files; leave it out where the
        partitions are few and large, as years are, since it moves all rows once more.
        """
        self.path, self.keys, self.by_arrival = path.rstrip("/"), list(keys), by_arrival
        self.schema, self.order_by, self.part, self.gather = schema, list(order_by), part, gather

    def open(self, rows: DataFrame) -> "KeyedLog":
        """Begin with the rows the table holds already; they count as older than any batch."""
        self._write([rows], -1)
        return self

    def open_empty(self, spark: SparkSession) -> "KeyedLog":
        return self.open(spark.createDataFrame([], self.schema))

    def begun(self, spark: SparkSession) -> bool:
        return exists(spark, f"{self.path}/batch=-1")

    def _claim(self, spark: SparkSession) -> None:
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if query is None:  # not called by a stream
            return
        owner = f"{self.path}/_owner"
        if not exists(spark, owner):
            spark.createDataFrame([(query,)], "query string").coalesce(1).write.mode("ignore").text(owner)
        known = spark.read.text(owner).first()
        if known is None or known[0] != query:
            raise RuntimeError(f"{self.path} is written by another query; fold it to a new path and go on there")

    def append(self, batch: DataFrame | Sequence[DataFrame], batch_id: int) -> None:
        """Write a batch; one of several frames, which share no key, is written frame by frame."""
        frames = [batch] if isinstance(batch, DataFrame) else list(batch)
        self._claim(frames[0].sparkSession)
        self._write([latest_per_key(frame, self.keys, self.order_by) if self.order_by else frame for frame in frames], batch_id)

    def _order(self) -> list[str]:
        return ["batch", *self.order_by] if self.by_arrival else [*self.order_by, "batch"]

    def _write(self, frames: Sequence[DataFrame], batch_id: int) -> None:
        frames = [rows.select(*self.schema.names) for rows in frames]
        if self.part:
            frames = [layout(rows.withColumn(PART, F.expr(self.part)), [PART] if self.gather else []) for rows in frames]
        write_once(frames, f"{self.path}/batch={batch_id}", [PART] if self.part else [])

    def _read(self, spark: SparkSession, path: str, *more: T.StructField) -> DataFrame:
        part = [T.StructField(PART, T.StringType())] if self.part else []
        return spark.read.schema(T.StructType([*self.schema, *part, *more])).parquet(path)

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return self._read(spark, f"{self.path}/batch={batch_id}")

    def last_batch(self, spark: SparkSession) -> int:
        """The id of the newest batch; -1 is the table's beginning."""
        return max(int(name.removeprefix("batch=")) for name in folders(spark, self.path) if name.startswith("batch="))

    def parts(self, spark: SparkSession, batch_id: int) -> list[str | None]:
        """The partitions of a batch, from the names of its folders."""
        return list(self._held(spark, batch_id, -1))

    def _held(self, spark: SparkSession, batch_id: int, before: int) -> dict[str | None, int]:
        """The partitions of a batch, each with the bytes that the batches before ``before`` hold of it."""
        held = {name: 0 for name in folders(spark, f"{self.path}/batch={batch_id}") if name.startswith(f"{PART}=")}
        for batch in folders(spark, self.path):
            if batch.startswith("batch=") and int(batch.removeprefix("batch=")) < before:
                for name in held.keys() & set(folders(spark, f"{self.path}/{batch}")):
                    held[name] += stored_bytes(spark, f"{self.path}/{batch}/{name}")
        parts = [name.removeprefix(f"{PART}=") for name in held]
        return {None if part == NO_PART else unquote(part): size for part, size in zip(parts, held.values())}

    def steps(self, spark: SparkSession, batch_id: int) -> list[list[str | None] | None]:
        """The partitions of a batch in groups of about ``STEP_BYTES`` of stored rows, for work that takes one group at a time.

        No key is in two groups.  There is one group at least; it is None, for all rows, where nothing is partitioned.
        """
        if not self.part:
            return [None]
        groups, size = [[]], 0
        for part, more in sorted(self._held(spark, batch_id, batch_id + 1).items(), key=str):
            if groups[-1] and size + more > STEP_BYTES:
                groups, size = [*groups, []], 0
            groups[-1].append(part)
            size += more
        return groups

    def history(self, spark: SparkSession, before: int | None = None, parts: Sequence[str | None] | None = None) -> DataFrame:
        """All rows of all batches with their ``batch``; only the folders before ``before`` and of ``parts`` are read."""
        rows = self._read(spark, self.path, T.StructField("batch", T.LongType()))
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        return rows if parts is None or not self.part else rows.where(of_parts(parts)).drop(PART)

    def current(self, spark: SparkSession, before: int | None = None, of_keys: DataFrame | None = None) -> DataFrame:
        """The last row of each key, or of the keys in ``of_keys``, which are picked before anything is ranked."""
        rows = self.history(spark, before).drop(PART)
        if of_keys is not None:
            rows = rows.join(of_keys.select(*self.keys), self.keys, "left_semi")
        return latest_per_key(rows, self.keys, self._order()).drop("batch").select(*self.schema.names)

    def replaced(self, spark: SparkSession, batch_id: int, parts: Sequence[str | None] | None = None) -> DataFrame:
        """What a batch changes: the rows now current with ``sign`` 1, those current before it with -1.

        One pass over the history of the batch's keys, in the files of the batch's
        partitions where it has any, or of those in ``parts``.  A key has at most one row per batch
        there, so ranking it stays small.  In partitions that no older batch has, there is nothing to look up.
        """
        if not self.part:
            return self._looked_up(spark, batch_id, None)
        older = self._held(spark, batch_id, batch_id)
        parts = list(older) if parts is None else parts
        new = [part for part in parts if self.order_by and not older.get(part)]
        if not new:
            return self._looked_up(spark, batch_id, parts)
        known = F.lit(True)
        for key in self.keys:  # a row without a key is no version of another and changes nothing
            known = known & F.col(key).isNotNull()
        added = self.batch(spark, batch_id).where(of_parts(new) & known).select(*self.schema.names, F.lit(1).cast("bigint").alias("sign"))
        rest = [part for part in parts if part not in new]
        return added.unionByName(self._looked_up(spark, batch_id, rest)) if rest else added

    def _looked_up(self, spark: SparkSession, batch_id: int, parts: Sequence[str | None] | None) -> DataFrame:
        own = self.batch(spark, batch_id)
        if parts is not None:
            own = own.where(of_parts(parts))
        rows = self.history(spark, batch_id + 1, parts).join(own.select(*self.keys), self.keys, "left_semi")
        is_new = F.col("batch") == batch_id
        newest = Window.partitionBy(*self.keys).orderBy(*[F.desc_nulls_last(c) for c in self._order()])
        so_far = newest.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        older = F.sum((~is_new).cast("int")).over(so_far)
        ranked = rows.withColumn("_now", F.row_number().over(newest)).withColumn("_older", older)
        signs = F.array_compact(
            F.array(
                F.when(F.col("_now") == 1, F.lit(1).cast("bigint")),
                F.when(~is_new & (F.col("_older") == 1), F.lit(-1).cast("bigint")),
            )
        )
        return ranked.select(*self.schema.names, F.explode(signs).alias("sign"))

    def fold(self, spark: SparkSession, path: str) -> "KeyedLog":
        """A new log at ``path`` that starts from the current rows of this one."""
        return KeyedLog(path, self.schema, self.keys, self.order_by, self.by_arrival, self.part, self.gather).open(self.current(spark))


def apply_change_log(log: KeyedLog, spark: SparkSession) -> DataFrame:
    """The table behind a log of change rows: the last change of each key, without the deleted."""
    return log.current(spark).where("op <> 'd'").drop("op")
