"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Session-wide choices every job relies on.  Shuffle partitions are left to the
# cluster; adaptive execution merges them when a stage turns out small.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even if the split costs a later operator its co-location.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.compression.codec": "zstd",
    # Compressed files are smaller than what is broadcast; plans are to know.
    "spark.sql.sources.fileCompressionFactor": "2.0",
    # What a Python worker gets at a time, however long the texts are.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
}


def build_session(app: str = "tallyloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables, which every executor can reach.

    It lies under ``spark.checkpoint.dir``; where that is unset, as in tests, under the
    warehouse folder, which is shared as well.  ``release`` removes it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.work"
    return f"{base.rstrip('/')}/run-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete every intermediate table this application has written; frames that read them end with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within one file system; ``target`` must not exist."""
    paths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    system = paths[1].getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(paths[1].getParent())
    if not system.rename(*paths):
        raise RuntimeError(f"could not rename {source} to {target}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the entries of a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [status.getPath().getName() for status in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]


def work_path(spark: SparkSession, label: str) -> str:
    """A new path of its own under the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The bytes of all files below a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of every action inside when it ends.

    Spark leaves them until the driver collects its garbage, so a job of many
    actions would hold the files of all of them at once.
    """
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before) if before is not None else spark.conf.unset(RELEASE)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Used between layers, where a table stands in the warehouse anyway, and to cut
    lineage: the copy survives the loss of any executor.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, table: DataFrame) -> None:
    """Delete a table that ``stored`` wrote and that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getParent().getName() != shared_folder(spark).rsplit("/", 1)[1]:
            raise ValueError(f"{folder} is no intermediate table")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
