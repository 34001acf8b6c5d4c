"""Column expressions and small distributed helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import stored

# Words of the contracts, as Java and DuckDB regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(text: str | Column) -> Column:
    """A text with NULL read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; a text without other letters takes the quick way."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def n_words(text: str | Column, pattern: str = WORD) -> Column:
    return F.regexp_count(whole(text), F.lit(pattern)).cast("long")


def unit_interval(*parts: Column | str) -> Column:
    """A number in (0, 1) that only the given values decide: 52 bits of an MD5 sum."""
    joined = F.concat_ws(":", *(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    bits = F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(2**52)


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Rows with their place (from 0) in a total order, sorted in ranges rather than in one task.

    The ranges are written once, so that a row's range cannot change between the two
    uses; only a count per range meets in one place.
    """
    placed = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "numbered")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return placed.withColumn("_inside", inside).join(offsets, "_range").withColumn(
        out, F.col("_before") + F.col("_inside") - 1
    ).drop("_range", "_inside", "_before")


def slots(df: DataFrame, group: str, key: Column, order: list[Column], out: str, per_block: int = 50_000) -> DataFrame:
    """A gapless number from 0 in each group, without gathering a group in one task.

    Rows fall into blocks by a hash of ``key``; a row's number is its place in its
    block after the rows of the group's earlier blocks.  ``df`` is read three times and
    should be a stored table.
    """
    blocks = max(8, df.count() // per_block)
    blocked = df.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocked.groupBy(group, "_block").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select(group, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(group, "_block").orderBy(*order))
    return blocked.withColumn("_inside", inside).join(offsets, [group, "_block"]).withColumn(
        out, (F.col("_before") + F.col("_inside") - 1).cast("long")
    ).drop("_block", "_inside", "_before")
