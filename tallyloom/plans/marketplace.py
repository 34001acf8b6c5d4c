"""Marketplace chain: order messages to order and line facts, daily summaries and rankings.

Every function maps DataFrames to one table of ``contracts.MARKETPLACE`` and works
the same on a stored table, on derived data and inside a micro-batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.contracts import MARKETPLACE, apply_contract
from tallyloom.functions.scalars import day_text, ratio
from tallyloom.operators.filters import filter_paid
from tallyloom.operators.keyed import drop_null_keys, latest_per_key
from tallyloom.operators.ranking import rank_within

PAID = ("已支付",)

# Order versions from oldest to newest; the later columns only break ties.
VERSION_ORDER = ("proc_time", "create_time", "pay_status", "total_pay_amount")


def _present(df: DataFrame, table: str, *derived: str) -> list[str]:
    """The table's columns that ``df`` carries, so that unused ones need not be read."""
    return [c for c in MARKETPLACE[table].columns if c in df.columns or c in derived]


def dwd_order(orders: DataFrame) -> DataFrame:
    """The latest version of each order, with its day."""
    clean = drop_null_keys(orders, ["order_id", "total_pay_amount"])
    order_by = [c for c in VERSION_ORDER if c in orders.columns]
    latest = latest_per_key(clean, ["order_id"], order_by)
    dated = latest.withColumn("order_date", day_text("create_time"))
    return dated.select(*_present(dated, "dwd_marketplace_order"))


def order_detail(orders: DataFrame) -> DataFrame:
    """One row per order line.  Orders without lines (NULL or empty) have none to give."""
    lines = orders.withColumn("item", F.explode("items"))
    item_fields = orders.schema["items"].dataType.elementType.names
    renamed = {"pay_amount": "item_pay_amount"}
    flat = lines.select(
        *[c for c in orders.columns if c != "items"],
        *[F.col(f"item.{name}").alias(renamed.get(name, name)) for name in item_fields],
    )
    return flat.select(*_present(flat, "dwd_marketplace_order_detail"))


def _order_count(keyed: bool) -> Column:
    """Distinct orders.  Rows keyed by order are counted, which saves expanding them for a second distinct."""
    return F.count("order_id") if keyed else F.count_distinct("order_id")


def dws_shop_daily_gmv(orders: DataFrame, paid: tuple[str, ...] = PAID, keyed: bool = True) -> DataFrame:
    """Paid orders per shop and day.  ``keyed`` tells that ``order_id`` is unique, as in the DWD table."""
    daily = (
        filter_paid(orders, paid)
        .groupBy("shop_id", F.col("order_date").alias("stat_date"))
        .agg(
            F.max("shop_name").alias("shop_name"),
            _order_count(keyed).alias("order_cnt"),
            F.count_distinct("buyer_uid").alias("buyer_uv"),
            F.sum("total_pay_amount").alias("gmv"),
            F.sum("total_discount_amount").alias("discount_amt"),
            F.sum("freight_amount").alias("freight_amt"),
            F.sum(F.col("total_pay_amount") - F.col("freight_amount")).alias("net_pay_amt"),
            F.sum("total_quantity").alias("total_quantity"),
        )
    )
    return apply_contract(
        daily.withColumn("avg_order_amount", ratio("gmv", "order_cnt", 2)), MARKETPLACE["dws_shop_daily_gmv"]
    )


def _daily_lines(lines: DataFrame, group: str, labels: tuple[str, ...]) -> DataFrame:
    """Lines summed per group and day, with the orders, lines and buyers counted.

    The lines move once, to the place of their group, day and buyer.  There they become
    orders and then buyers without moving again, and buyers are counted where they are before the
    groups meet, so a hot group or day is spread over its buyers.
    """
    sums = [F.sum(c).alias(c) for c in ("quantity", "item_pay_amount", "discount_amount")]
    sums += [F.max(c).alias(c) for c in labels]
    place = [group, "stat_date", "buyer_uid"]
    orders = lines.repartition(*place).groupBy(*place, "order_id").agg(F.count("order_item_id").alias("_lines"), *sums)
    buyers = orders.groupBy(*place).agg(F.count("order_id").alias("_orders"), F.sum("_lines").alias("_lines"), *sums)
    return buyers.groupBy(group, "stat_date").agg(
        F.sum("_orders").alias("order_cnt"), F.sum("_lines").alias("sku_sold_cnt"), F.count("buyer_uid").alias("buyer_uv"), *sums
    )


def _daily_distinct(lines: DataFrame, group: str, labels: tuple[str, ...]) -> DataFrame:
    """The same for lines that need not be keyed: all three counts are distinct."""
    sums = [F.sum(c).alias(c) for c in ("quantity", "item_pay_amount", "discount_amount")]
    sums += [F.max(c).alias(c) for c in labels]
    counts = {"order_cnt": "order_id", "sku_sold_cnt": "order_item_id", "buyer_uv": "buyer_uid"}
    return lines.groupBy(group, "stat_date").agg(*(F.count_distinct(c).alias(out) for out, c in counts.items()), *sums)


def _daily_sales(detail: DataFrame, table: str, group: str, labels: tuple[str, ...], paid: tuple[str, ...], keyed: bool) -> DataFrame:
    lines = filter_paid(detail, paid).withColumn("stat_date", day_text("create_time"))
    daily = (_daily_lines if keyed else _daily_distinct)(lines, group, labels)
    named = daily.withColumnsRenamed({"item_pay_amount": "gmv", "discount_amount": "discount_amt"})
    return apply_contract(named, MARKETPLACE[table])


def dws_spu_daily_sales(detail: DataFrame, paid: tuple[str, ...] = PAID, keyed: bool = True) -> DataFrame:
    """Paid lines per product and day.

    ``keyed`` tells that a line's id is unique in its product and day, and that an order has
    one buyer, as in the DWD table; otherwise all three counts are distinct.
    """
    return _daily_sales(detail, "dws_spu_daily_sales", "spu_id", ("spu_name", "brand"), paid, keyed)


def dws_category_daily_sales(detail: DataFrame, paid: tuple[str, ...] = PAID, keyed: bool = True) -> DataFrame:
    """Paid lines per category and day; ``keyed`` tells that an order has one buyer."""
    return _daily_sales(detail, "dws_category_daily_sales", "company_category_id", ("company_category_path",), paid, keyed)


def dws_user_daily_activity(orders: DataFrame, paid: tuple[str, ...] = PAID, keyed: bool = True) -> DataFrame:
    """Buyers per day.  New buyers are not told apart here: the column repeats the buyer count."""
    daily = (
        filter_paid(orders, paid)
        .groupBy(F.col("order_date").alias("stat_date"))
        .agg(
            F.count_distinct("buyer_uid").alias("buyer_uv"),
            _order_count(keyed).alias("order_cnt"),
            F.sum("total_pay_amount").alias("gmv"),
        )
    )
    rows = daily.select(
        "*",
        F.col("buyer_uv").alias("new_buyer_uv"),
        ratio("order_cnt", "buyer_uv", 2).alias("avg_orders_per_user"),
        ratio("gmv", "buyer_uv", 2).alias("avg_gmv_per_user"),
    )
    return apply_contract(rows, MARKETPLACE["dws_user_daily_activity"])


def new_buyers_exact(orders: DataFrame, paid: tuple[str, ...] = PAID) -> DataFrame:
    """Per day the buyers, and those whose first paid order in ``orders`` is of that day.

    The first day is a minimum per buyer, reduced in the map tasks; ``orders`` must reach
    back as far as "new" is to mean.
    """
    bought = filter_paid(orders, paid).where("buyer_uid IS NOT NULL").select("buyer_uid", F.col("order_date").alias("stat_date"))
    first = bought.groupBy("buyer_uid").agg(F.min("stat_date").alias("stat_date"))
    new = first.groupBy("stat_date").agg(F.count(F.lit(1)).alias("new_buyer_uv"))
    daily = bought.groupBy("stat_date").agg(F.count_distinct("buyer_uid").alias("buyer_uv")).join(new, "stat_date", "left")
    counts = daily.withColumn("new_buyer_uv", F.coalesce("new_buyer_uv", F.lit(0)))
    return counts.select("stat_date", "buyer_uv", "new_buyer_uv", ratio("new_buyer_uv", "buyer_uv", 4).alias("new_buyer_share"))


def overview_exact_buyers(orders: DataFrame, shops: DataFrame, paid: tuple[str, ...] = PAID) -> DataFrame:
    """The overview's buyers, summed over shops, next to the day's different buyers."""
    summed = shops.groupBy("stat_date").agg(F.sum("buyer_uv").cast("long").alias("buyer_uv_by_shop"))
    exact = filter_paid(orders, paid).groupBy(F.col("order_date").alias("stat_date")).agg(F.count_distinct("buyer_uid").alias("buyer_uv"))
    return exact.join(summed, "stat_date", "left")


def ads_realtime_overview(shops: DataFrame) -> DataFrame:
    """All shops per day.  A buyer of two shops counts in both: the daily figure is a sum over shops."""
    daily = shops.groupBy("stat_date").agg(
        F.sum("gmv").alias("gmv"),
        F.sum("order_cnt").alias("order_cnt"),
        F.sum("buyer_uv").alias("buyer_uv"),
        F.sum("discount_amt").alias("discount_amt"),
        F.sum("freight_amt").alias("freight_amt"),
    )
    rows = daily.select(
        "*",
        F.col("order_cnt").alias("paid_order_cnt"),
        F.col("gmv").alias("paid_gmv"),
        F.col("buyer_uv").alias("paid_buyer_uv"),
        ratio("gmv", "order_cnt", 2).alias("avg_order_amount"),
    )
    return apply_contract(rows, MARKETPLACE["ads_realtime_overview"])


def ads_shop_rank_daily(shops: DataFrame) -> DataFrame:
    """Every shop of a day ranked by sales."""
    return apply_contract(rank_within(shops, "stat_date", "gmv", "shop_id"), MARKETPLACE["ads_shop_rank_daily"])


def ads_top_spu_daily(spus: DataFrame) -> DataFrame:
    """Every product of a day ranked by sales."""
    return apply_contract(rank_within(spus, "stat_date", "gmv", "spu_id"), MARKETPLACE["ads_top_spu_daily"])
