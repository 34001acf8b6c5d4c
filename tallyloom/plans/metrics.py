"""The analyst's questions over the published tables.

A period total always starts from the daily summaries; ranking tables hold ranks
of single days and are never summed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalars import category_level, money_text, ratio
from tallyloom.operators.filters import filter_recent_days, filter_single_day
from tallyloom.operators.ranking import top

DEFAULT_DAYS = 7
DEFAULT_TOP = 10
DETAIL_CAP = 200
SUMMARY_CAP = 100
ANSWER_ROWS = 10


def metric_trend(table: DataFrame, metric: str, days: int = DEFAULT_DAYS, as_of: str | Column | None = None) -> DataFrame:
    """One metric per day, oldest first."""
    return filter_recent_days(table, days, as_of).select("stat_date", metric).orderBy("stat_date")


def shop_trend(
    shops: DataFrame, shop_id: str, metrics: Sequence[str], days: int = DEFAULT_DAYS, as_of: str | Column | None = None
) -> DataFrame:
    one = filter_recent_days(shops.where(F.col("shop_id") == shop_id), days, as_of)
    return one.select("stat_date", "shop_id", *metrics).orderBy("stat_date")


def metric_total_period(daily: DataFrame, dims: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Sums of daily metrics per dimension over whatever period ``daily`` was filtered to."""
    return daily.groupBy(*dims).agg(*[F.sum(c).alias(c) for c in metrics])


def avg_order_amount(daily: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Sales per order of a period, from the period's sums and not from daily averages."""
    totals = metric_total_period(daily, dims, ["gmv", "order_cnt"])
    return totals.withColumn("avg_order_amount", ratio("gmv", "order_cnt", 2))


def net_pay_compare(shops: DataFrame) -> DataFrame:
    return metric_total_period(shops, ["shop_id", "shop_name"], ["net_pay_amt"]).orderBy(F.desc("net_pay_amt"), "shop_id")


def brand_sales(spus: DataFrame) -> DataFrame:
    return metric_total_period(spus, ["brand"], ["gmv", "quantity", "order_cnt"]).orderBy(F.desc("gmv"), "brand")


def category_level1_rank(categories: DataFrame, n: int | None = None) -> DataFrame:
    """Sales of the categories of the first level, all of them unless ``n`` is given."""
    levelled = categories.withColumn("category_level1", category_level("company_category_path", 1))
    totals = metric_total_period(levelled, ["category_level1"], ["gmv"])
    return top(totals, n, F.desc("gmv"), F.asc("category_level1"))


def new_buyer_share(activity: DataFrame) -> DataFrame:
    share = ratio("new_buyer_uv", "buyer_uv", 4).alias("new_buyer_share")
    return activity.select("stat_date", "new_buyer_uv", "buyer_uv", share).orderBy("stat_date")


# What a way of asking for "the best" sorts by.
SORT_PHRASES = {
    "卖得最好": "gmv",
    "最畅销": "gmv",
    "爆款": "gmv",
    "卖得最多": "gmv",
    "最好卖": "gmv",
    "头号": "gmv",
    "销量最高": "quantity",
    "卖得最多件": "quantity",
    "卖得数量最多": "quantity",
    "人气最高": "buyer_uv",
    "买的人最多": "buyer_uv",
    "访客最多": "buyer_uv",
    "客单价最高": "avg_order_amount",
}


def _period_metric(daily: DataFrame, metric: str) -> Column:
    if metric == "avg_order_amount":
        return ratio(F.sum("gmv"), F.sum("order_cnt"), 2)
    if metric == "quantity" and "total_quantity" in daily.columns:
        return F.sum("total_quantity")
    return F.sum(metric)


def rank_by_metric(daily: DataFrame, dims: Sequence[str], meaning: str, n: int = DEFAULT_TOP) -> DataFrame:
    """The top ``n`` by what ``meaning`` asks for: a metric name or one of ``SORT_PHRASES``."""
    metric = SORT_PHRASES.get(meaning, meaning)
    totals = daily.groupBy(*dims).agg(_period_metric(daily, metric).alias("metric_value"))
    return top(totals, n, F.desc_nulls_last("metric_value"), *[F.asc(d) for d in dims])


def top_shops_day(ranking: DataFrame, day: str, n: int = DEFAULT_TOP) -> DataFrame:
    rows = filter_single_day(ranking, day).select("rank_no", "shop_id", "shop_name", "gmv")
    return top(rows, n, F.asc("rank_no"))


def top_spu_period(spus: DataFrame, n: int = DEFAULT_TOP) -> DataFrame:
    """Best products of a period, summed from the daily summaries."""
    totals = spus.groupBy("spu_id").agg(
        F.max("spu_name").alias("spu_name"),
        F.max("brand").alias("brand"),
        F.sum("gmv").alias("gmv"),
        F.sum("quantity").alias("quantity"),
    )
    return top(totals, n, F.desc("gmv"), F.asc("spu_id"))


def row_cap(df: DataFrame, order: Sequence[Column], n: int = DEFAULT_TOP, detail: bool = False) -> DataFrame:
    """At most ``n`` rows and never more than the cap of detail or summary answers."""
    return top(df, min(n, DETAIL_CAP if detail else SUMMARY_CAP), *order)


def answer_table(
    df: DataFrame, money: Sequence[str], counts: Sequence[str], order: Sequence[Column], rows: int | None = ANSWER_ROWS
) -> DataFrame:
    """The first ``rows`` rows for reading (ten, as answers show; None for all): money with separators and two decimals, counts as whole numbers."""
    first = top(df, rows, *order)
    shown = {c: money_text(c) for c in money} | {c: F.format_number(F.col(c), 0) for c in counts}
    return first.select(*[shown[c].alias(c) if c in shown else F.col(c) for c in df.columns])
