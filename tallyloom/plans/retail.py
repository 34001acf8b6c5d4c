"""Retail chain: cleaned users, products and orders to daily summaries and published tables.

Every function maps DataFrames to one table of ``contracts.RETAIL``.  Summaries
with one distinct count are planned as two partial aggregations, first by group
and distinct value, so a hot channel or province is spread over its users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.contracts import RETAIL, apply_contract, split_null_keys
from tallyloom.functions.scalars import count_if, distinct_if, is_one_of, ratio, sum_if
from tallyloom.operators.joins import join_left_dim

PAID = "paid"
REFUNDED = "refunded"


def dwd_user_info(users: DataFrame) -> DataFrame:
    return apply_contract(users, RETAIL["dwd_user_info"])


def dwd_product_info(products: DataFrame) -> DataFrame:
    return apply_contract(products, RETAIL["dwd_product_info"])


def dwd_order_info(orders: DataFrame) -> DataFrame:
    """Orders with a positive amount, flagged 0/1 for refunds."""
    clean = orders.where(F.col("order_amount").isNotNull() & (F.col("order_amount") > 0))
    flagged = clean.withColumn("is_refunded", F.when(F.col("order_status") == REFUNDED, 1).otherwise(0))
    return apply_contract(flagged, RETAIL["dwd_order_info"])


def dws_channel_order_day(orders: DataFrame, paid: tuple[str, ...] | str = PAID) -> DataFrame:
    is_paid = is_one_of("order_status", paid)
    daily = orders.groupBy("dt", "channel").agg(
        F.count_distinct("user_id").alias("uv"),
        F.count(F.lit(1)).alias("order_cnt"),
        count_if(is_paid).alias("paid_order_cnt"),
        sum_if(is_paid, "order_amount").alias("gmv"),
        count_if(F.col("order_status") == REFUNDED).alias("refund_cnt"),
    )
    return apply_contract(daily, RETAIL["dws_channel_order_day"])


def dws_province_order_day(orders: DataFrame, paid: tuple[str, ...] | str = PAID) -> DataFrame:
    is_paid = is_one_of("order_status", paid)
    daily = orders.groupBy("dt", "province").agg(
        F.count(F.lit(1)).alias("order_cnt"),
        count_if(is_paid).alias("paid_order_cnt"),
        distinct_if(is_paid, "user_id").alias("paid_user_cnt"),
        sum_if(is_paid, "order_amount").alias("gmv"),
    )
    return apply_contract(daily, RETAIL["dws_province_order_day"])


def dws_product_sales_day(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per product and day, refunded orders included.

    Orders are summed before the product names are looked up: the join sees one
    row per product and day instead of every order of a best seller.
    """
    sales = orders.groupBy("dt", "product_id").agg(
        F.count(F.lit(1)).alias("sale_cnt"), F.sum("order_amount").alias("sale_amount")
    )
    named = join_left_dim(sales, products, "product_id", ["product_name", "category_name"])
    return apply_contract(named, RETAIL["dws_product_sales_day"])


def dws_user_growth_day(users: DataFrame) -> DataFrame:
    daily = users.groupBy(F.col("register_date").alias("dt"), "register_channel").agg(
        F.count(F.lit(1)).alias("new_user_cnt")
    )
    return apply_contract(daily, RETAIL["dws_user_growth_day"])


def ads_trade_overview_di(orders: DataFrame, paid: tuple[str, ...] | str = PAID) -> DataFrame:
    is_paid = is_one_of("order_status", paid)
    daily = orders.groupBy("dt").agg(
        F.count(F.lit(1)).alias("total_order_cnt"),
        count_if(is_paid).alias("paid_order_cnt"),
        sum_if(is_paid, "order_amount").alias("total_gmv"),
        distinct_if(is_paid, "user_id").alias("paid_user_cnt"),
    )
    return apply_contract(daily, RETAIL["ads_trade_overview_di"])


def ads_channel_conversion_di(channels: DataFrame, visits_per_buyer: int = 10) -> DataFrame:
    """Conversion per channel.  Visits are not measured; they are taken as a multiple of the buyers."""
    visits = F.col("uv") * visits_per_buyer
    rows = channels.select(
        "dt",
        "channel",
        visits.alias("visit_uv"),
        "order_cnt",
        "paid_order_cnt",
        "gmv",
        ratio("order_cnt", visits, 4).alias("order_conversion_rate"),
        ratio("paid_order_cnt", visits, 4).alias("pay_conversion_rate"),
    )
    return apply_contract(rows, RETAIL["ads_channel_conversion_di"])


def ads_region_gmv_di(provinces: DataFrame) -> DataFrame:
    return apply_contract(provinces, RETAIL["ads_region_gmv_di"])


def ads_product_sales_rank_di(sales: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The published table, and the rows whose product id is not a number."""
    numbered = sales.withColumn("_text_id", F.col("product_id")).withColumn(
        "product_id", F.col("product_id").try_cast("bigint")
    )
    good, bad = split_null_keys(numbered, RETAIL["ads_product_sales_rank_di"])
    return (
        apply_contract(good, RETAIL["ads_product_sales_rank_di"]),
        bad.withColumn("product_id", F.col("_text_id")).select(*sales.columns),
    )


def ads_user_growth_di(growth: DataFrame) -> DataFrame:
    return apply_contract(growth, RETAIL["ads_user_growth_di"])


def mv_trade_overview(overview: DataFrame) -> DataFrame:
    """The precomputed daily roll-up of the trade overview; write it as a table to serve it."""
    return overview.groupBy("dt").agg(
        F.sum("total_gmv").alias("sum_gmv"),
        F.sum("total_order_cnt").alias("sum_order_cnt"),
        F.sum("paid_order_cnt").alias("sum_paid_order_cnt"),
    )
