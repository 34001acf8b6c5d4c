"""JSON events to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.contracts import EVENTS

WATERMARK_DELAY = "5 seconds"

# The two ways a timestamp may be written.
SQL_CLOCK = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,9})?$"
ISO_CLOCK = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?$"


def _as_text(kind: T.DataType) -> T.DataType:
    """The same shape with every leaf as text, so one bad value cannot spoil its neighbours."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    return T.StringType()


def _typed(value: Column, kind: T.DataType, clock: str) -> Column:
    if isinstance(kind, T.StructType):
        fields = [_typed(value.getField(f.name), f.dataType, clock).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _typed(item, kind.elementType, clock))
    if isinstance(kind, T.TimestampType):
        return F.when(value.rlike(clock), value.try_cast(kind))
    if isinstance(kind, T.StringType):
        return value
    return value.try_cast(kind)


def decode(
    df: DataFrame, schema: T.StructType, clock: str = SQL_CLOCK, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Decode a JSON text column.

    A text that is no JSON object is skipped; a field that is missing or does not
    fit its type becomes NULL.  ``keep`` names columns to carry along.

    Each text is parsed once.  The parser also marks texts whose lists or structs
    do not fit; only those are looked at again to tell a bad field from no JSON.
    """
    text = F.col(value)
    shape = T.StructType([*_as_text(schema), T.StructField("_bad", T.StringType())])
    row = F.from_json(text, shape, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})

    def is_object(parsed: Column) -> Column:
        sound = parsed["_bad"].isNull() | F.try_parse_json(parsed["_bad"]).isNotNull()
        return F.startswith(F.ltrim(text), F.lit("{")) & sound

    parsed = df.select(*keep, F.explode(F.filter(F.array(row), is_object)).alias("_json"))
    return parsed.select(*keep, *[_typed(F.col(f"_json.`{f.name}`"), f.dataType, clock).alias(f.name) for f in schema])


def decode_event(df: DataFrame, kind: str, keep: Sequence[str] = ()) -> DataFrame:
    """One of the six event payloads of ``contracts.EVENTS``."""
    return decode(df, EVENTS[kind].schema, keep=keep)


def with_proc_time(df: DataFrame) -> DataFrame:
    """Stamp rows with the time they are processed at, once per batch."""
    return df.withColumn("proc_time", F.current_timestamp())


def with_event_watermark(df: DataFrame, column: str = "event_time", delay: str = WATERMARK_DELAY) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def drop_repeats(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of those that repeat ``keys`` within the watermark's delay; the state holds a key that long and no longer.

    ``events`` is a stream with a watermark.  A repeat that comes later than the delay is
    a new row, unless it is late for the watermark itself.
    """
    return events.dropDuplicatesWithinWatermark(list(keys))


def order_event_amounts(events: DataFrame, scale: int = 1) -> DataFrame:
    """Whole-number amounts of ``order_events`` as decimals; ``scale`` is 100 when they are cents."""
    amounts = ("order_amount", "pay_amount", "post_amount")
    return events.withColumns({c: (F.col(c).cast("decimal(20,0)") / F.lit(scale)).cast("decimal(18,2)") for c in amounts})


def marketplace_event_amounts(events: DataFrame) -> DataFrame:
    """Text amounts of ``marketplace_events`` as decimals, NULL when they are no number."""
    return events.withColumns({c: F.col(c).try_cast("decimal(18,2)") for c in ("payment", "total_fee", "discount_fee")})


def read_kafka(
    spark: SparkSession, topic: str, servers: str, group: str | None = None, start: str = "latest", **options: str
) -> DataFrame:
    """A topic as a stream with a text ``value``; needs Spark's Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .options(**options)
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    place = ["topic", "partition", "offset", "timestamp"]
    return reader.load().select(F.col("value").cast("string").alias("value"), *place)
