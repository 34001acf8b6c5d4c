"""Daily summaries kept up to date while rows are added, changed and withdrawn.

A micro-batch looks up the rows it replaces and records only the difference: the
new rows' amounts and the old rows' with the opposite sign, cut to the columns that the
summary needs.  They are summed at the grain of the distinct counts when a group is
worked out, after one exchange.  A hot shop therefore costs what its changes cost, not its whole
history.  Distinct counts stay exact because a buyer leaves a group when the count
of their live rows there reaches zero.

All state is in written tables keyed by the batch id and, below it, by day, month or year.  A batch
reads the files of the days it touches, so its cost does not grow with the history.  Where those are
large it takes some of them at a time, so what it shuffles at once stays bounded, too.  A replayed
batch reads only older batches and finds its own output in place, so the result is
exactly once.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.contracts import MARKETPLACE, Table
from tallyloom.functions.scalars import ratio
from tallyloom.operators.filters import filter_paid
from tallyloom.sinks.tables import layout, write_once
from tallyloom.streaming.keyed_log import PART, KeyedLog, of_parts

DATE = "stat_date"
DAY, MONTH, YEAR = 10, 7, 4  # leading signs of a date


@dataclass(frozen=True)
class Summary:
    """What a daily summary counts and sums."""

    table: Table
    names: tuple[str, ...]  # columns carried through as the largest value
    distinct: Mapping[str, str]  # output column -> counted column
    sums: Mapping[str, str]  # output column -> summed expression
    stat_date: str  # expression of the day
    rows: str | None = None  # output column that counts the rows
    ratios: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    copies: Mapping[str, str] = field(default_factory=dict)

    def part(self, span: int) -> str:
        """The expression that partitions its rows by ``DAY``, ``MONTH`` or ``YEAR``; take the shortest that holds some megabytes a batch."""
        return f"left({self.stat_date}, {span})"

    @property
    def reads(self) -> set[str]:
        """The columns of its rows that it needs."""
        expressions = " ".join([self.stat_date, *self.sums.values()])
        return {*self.table.keys, *self.names, *self.distinct.values(), "pay_status", *re.findall(r"\w+", expressions)}

    @property
    def grain(self) -> list[str]:
        seen = [*self.table.keys, *self.names, *self.distinct.values()]
        return list(dict.fromkeys(seen))


SHOP = Summary(
    MARKETPLACE["dws_shop_daily_gmv"],
    names=("shop_name",),
    distinct={"buyer_uv": "buyer_uid"},
    sums={
        "gmv": "total_pay_amount",
        "discount_amt": "total_discount_amount",
        "freight_amt": "freight_amount",
        "net_pay_amt": "total_pay_amount - freight_amount",
        "total_quantity": "total_quantity",
    },
    stat_date="order_date",
    rows="order_cnt",
    ratios={"avg_order_amount": ("gmv", "order_cnt")},
)
BUYER = Summary(
    MARKETPLACE["dws_user_daily_activity"],
    names=(),
    distinct={"buyer_uv": "buyer_uid"},
    sums={"gmv": "total_pay_amount"},
    stat_date="order_date",
    rows="order_cnt",
    ratios={"avg_orders_per_user": ("order_cnt", "buyer_uv"), "avg_gmv_per_user": ("gmv", "buyer_uv")},
    copies={"new_buyer_uv": "buyer_uv"},
)
SPU = Summary(
    MARKETPLACE["dws_spu_daily_sales"],
    names=("spu_name", "brand"),
    distinct={"order_cnt": "order_id", "sku_sold_cnt": "order_item_id", "buyer_uv": "buyer_uid"},
    sums={"quantity": "quantity", "gmv": "item_pay_amount", "discount_amt": "discount_amount"},
    stat_date="date_format(create_time, 'yyyy-MM-dd')",
)
CATEGORY = Summary(
    MARKETPLACE["dws_category_daily_sales"],
    names=("company_category_path",),
    distinct={"order_cnt": "order_id", "buyer_uv": "buyer_uid"},
    sums={"quantity": "quantity", "gmv": "item_pay_amount", "discount_amt": "discount_amount"},
    stat_date="date_format(create_time, 'yyyy-MM-dd')",
)


class RevisingSummary:
    """One summary fed by micro-batches of versions of keyed rows."""

    def __init__(self, summary: Summary, rows: KeyedLog, path: str, paid: tuple[str, ...]):
        spans = {summary.part(span): span for span in (DAY, MONTH, YEAR)}
        if rows.part and rows.part not in spans:
            raise ValueError(f"rows are partitioned by {rows.part}, which is no part of the summary's date")
        self.span = spans.get(rows.part)
        self.summary, self.rows, self.paid = summary, rows, paid
        self.path = path.rstrip("/")
        self.published = KeyedLog(
            f"{self.path}/published",
            T.StructType([*summary.table.schema, T.StructField("live", T.BooleanType())]),
            summary.table.keys,
            [],
            by_arrival=True,
        )

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` step."""
        spark = batch.sparkSession
        if not self.published.begun(spark):
            self.published.open_empty(spark)
        self.rows.append(batch, batch_id)
        steps = self.rows.steps(spark, batch_id)
        self._record([self._amounts(self.rows.replaced(spark, batch_id, parts)) for parts in steps], self.path, batch_id)
        self._publish(spark, batch_id, steps)

    def result(self, spark: SparkSession) -> DataFrame:
        """The summary as of the last batch."""
        return self.published.current(spark).where("live").drop("live")

    def fold(self, spark: SparkSession, path: str) -> "RevisingSummary":
        """The same summary at a new path, its batches so far merged into one; the stream goes on with it."""
        folded = RevisingSummary(self.summary, self.rows.fold(spark, f"{path}/rows"), path, self.paid)
        current = folded.rows.current(spark).withColumn("sign", F.lit(1).cast("bigint"))
        self._record([folded._amounts(current)], folded.path, -1)
        folded.published.open(self.published.current(spark).where("live"))
        return folded

    def _record(self, frames: Sequence[DataFrame], path: str, batch_id: int) -> None:
        folder = f"{path}/changes/batch={batch_id}"
        if self.rows.part:
            dated = [changes.withColumn(PART, F.left(DATE, F.lit(self.span))) for changes in frames]
            write_once([layout(changes, [PART] if self.rows.gather else []) for changes in dated], folder, [PART])
        else:
            write_once(frames, folder)

    def _changes(self, spark: SparkSession) -> DataFrame:
        """All recorded differences with their ``batch``."""
        none = spark.createDataFrame([], T.StructType([*self.rows.schema, T.StructField("sign", T.LongType())]))
        schema = self._amounts(none).schema
        part = [T.StructField(PART, T.StringType())] if self.rows.part else []
        return spark.read.schema(T.StructType([*schema, *part, T.StructField("batch", T.LongType())])).parquet(f"{self.path}/changes")

    def _amounts(self, rows: DataFrame) -> DataFrame:
        """Rows reduced to the columns of the grain, their sign and signed amounts."""
        dated = filter_paid(rows, self.paid).withColumn(DATE, F.expr(self.summary.stat_date))
        columns: list[Column | str] = [*self.summary.grain, F.col("sign").alias("_rows")]
        for name, expression in self.summary.sums.items():
            value = F.expr(expression)
            columns.append(F.when(F.col("sign") < 0, -value).otherwise(value).alias(name))
        return dated.select(*columns)

    def _net(self, changes: DataFrame) -> DataFrame:
        """Changes summed at the grain; each amount comes with its count of values."""
        totals = [F.sum("_rows").alias("_rows"), F.max("_new").alias("_new")]
        for name in self.summary.sums:
            kind = "decimal(38,2)" if isinstance(changes.schema[name].dataType, T.DecimalType) else "bigint"
            totals.append(F.coalesce(F.sum(name).cast(kind), F.lit(0).cast(kind)).alias(name))
            totals.append(F.sum(F.when(F.col(name).isNull(), 0).otherwise(F.col("_rows"))).alias(f"_n_{name}"))
        return changes.groupBy(*self.summary.grain).agg(*totals)

    def _publish(self, spark: SparkSession, batch_id: int, steps: Sequence[Sequence[str | None] | None]) -> None:
        """Work out the groups this batch touched and publish them; a group without rows is withdrawn.

        The changes move once, to a place where all sums and counts of their group can be
        taken.  With one distinct count that is the place of the group and the counted value, so a
        hot group is spread; with more it is the place of the group, one day's part of the table.
        A group lies in one partition, so ``steps`` are published one after the other.
        """
        keys, counted = self.summary.table.keys, set(self.summary.distinct.values())
        changes = self._changes(spark).where(F.col("batch") <= batch_id).dropna(subset=list(keys))
        frames = []
        for parts in steps:
            own = changes if parts is None else changes.where(of_parts(parts))
            marked = own.withColumn("_new", F.col("batch") == batch_id).drop("batch", PART)
            placed = marked.repartition(*keys, *(counted if len(counted) == 1 else ()))
            frames.append(self._finish(self._net(placed)))
        self.published.append(frames if len(frames) > 1 else frames[0], batch_id)

    def _finish(self, net: DataFrame) -> DataFrame:
        """The figures of each group of ``net`` with a new change; one without live rows has ``live`` false."""
        s = self.summary
        live = F.col("_rows") > 0
        firsts = {}
        for out, c in s.distinct.items():  # a value counts at the first of its live rows
            order = Window.partitionBy(*s.table.keys, c).orderBy(live.desc())
            firsts[f"_first_{out}"] = ((F.row_number().over(order) == 1) & live & F.col(c).isNotNull()).cast("bigint")
        figures = [F.max("_new").alias("_new"), F.max(live).alias("live")]
        figures += [F.max(F.when(live, F.col(c))).alias(c) for c in s.names]
        figures += [F.sum(f"_first_{out}").alias(out) for out in s.distinct]
        figures += [F.when(F.sum(F.when(live, F.col(f"_n_{c}"))) > 0, F.sum(F.when(live, F.col(c)))).alias(c) for c in s.sums]
        if s.rows:
            figures.append(F.sum(F.when(live, F.col("_rows"))).alias(s.rows))
        totals = net.withColumns(firsts).groupBy(*s.table.keys).agg(*figures).where("_new")
        totals = totals.withColumns(
            {out: ratio(a, b, 2) for out, (a, b) in s.ratios.items()} | {out: F.col(c) for out, c in s.copies.items()}
        )
        return totals.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.published.schema))
