"""Checked queries of the retail chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom import bindings as b
from tallyloom.contracts import RETAIL, apply_contract
from tallyloom.functions.scalars import count_if, distinct_if, sum_if
from tallyloom.operators.joins import join_left_dim
from tallyloom.plans import retail as r
from tallyloom.registry.base import query
from tallyloom.registry.sql import clock, doubles, rounded
from tallyloom.session import work_path
from tallyloom.sinks.tables import overwrite_partitions, read_table


@query("dwd_user_info", ("r_users",), "SELECT user_id, user_name, register_channel, register_date FROM r_users")
def dwd_user_info(t):
    return r.dwd_user_info(b.retail_users(t))


@query("dwd_product_info", ("r_products",), "SELECT product_id, product_name, category_name FROM r_products")
def dwd_product_info(t):
    return r.dwd_product_info(b.retail_products(t))


@query(
    "dwd_order_info",
    ("r_dwd",),
    f"SELECT * REPLACE (CAST(order_amount AS DOUBLE) AS order_amount, {clock('create_time')}) FROM r_dwd",
)
def dwd_order_info(t):
    return orders(t)


def orders(t):
    return r.dwd_order_info(b.retail_orders(t))


def products(t):
    return r.dwd_product_info(b.retail_products(t))


def users(t):
    return r.dwd_user_info(b.retail_users(t))


@query(
    "join_left_dim",
    ("r_dwd", "r_products"),
    """SELECT order_id, o.product_id, CAST(order_amount AS DOUBLE) AS order_amount, product_name, category_name
       FROM r_dwd o LEFT JOIN r_products p ON o.product_id = p.product_id""",
)
def left_dim(t):
    facts = orders(t).select("order_id", "product_id", "order_amount")
    return join_left_dim(facts, products(t), "product_id", ["product_name", "category_name"])


@query("dws_channel_order_day", ("r_channel",), doubles("r_channel", "gmv"))
def channel_day(t):
    return r.dws_channel_order_day(orders(t))


@query("dws_province_order_day", ("r_province",), doubles("r_province", "gmv"))
def province_day(t):
    return r.dws_province_order_day(orders(t))


@query("dws_product_sales_day", ("r_product",), doubles("r_product", "sale_amount"))
def product_day(t):
    return r.dws_product_sales_day(orders(t), products(t))


@query("dws_user_growth_day", ("r_growth",), doubles("r_growth"))
def growth_day(t):
    return r.dws_user_growth_day(users(t))


@query("ads_trade_overview_di", ("r_overview",), doubles("r_overview", "total_gmv"))
def trade_overview(t):
    return r.ads_trade_overview_di(orders(t))


@query(
    "ads_channel_conversion_di",
    ("r_channel",),
    f"""SELECT dt, channel, uv * 10 AS visit_uv, order_cnt, paid_order_cnt, CAST(gmv AS DOUBLE) AS gmv,
               {rounded("10000 * order_cnt", "uv * 10", 4)} AS order_conversion_rate,
               {rounded("10000 * paid_order_cnt", "uv * 10", 4)} AS pay_conversion_rate
        FROM r_channel""",
)
def channel_conversion(t):
    return r.ads_channel_conversion_di(r.dws_channel_order_day(orders(t)))


@query("ads_region_gmv_di", ("r_province",), doubles("r_province", "gmv"))
def region_gmv(t):
    return r.ads_region_gmv_di(r.dws_province_order_day(orders(t)))


@query(
    "ads_product_sales_rank_di",
    ("r_product",),
    """SELECT dt, TRY_CAST(product_id AS BIGINT) AS product_id, product_name, category_name, sale_cnt,
              CAST(sale_amount AS DOUBLE) AS sale_amount
       FROM r_product WHERE TRY_CAST(product_id AS BIGINT) IS NOT NULL""",
)
def product_rank(t):
    return r.ads_product_sales_rank_di(r.dws_product_sales_day(orders(t), products(t)))[0]


@query(
    "ads_product_sales_quarantine",
    ("r_product",),
    doubles("r_product", "sale_amount", tail="WHERE TRY_CAST(product_id AS BIGINT) IS NULL"),
)
def product_quarantine(t):
    return r.ads_product_sales_rank_di(r.dws_product_sales_day(orders(t), products(t)))[1]


@query("ads_user_growth_di", ("r_growth",), doubles("r_growth"))
def user_growth(t):
    return r.ads_user_growth_di(r.dws_user_growth_day(users(t)))


@query(
    "mv_trade_overview",
    ("r_overview",),
    """SELECT dt, CAST(sum(total_gmv) AS DOUBLE) AS sum_gmv, CAST(sum(total_order_cnt) AS BIGINT) AS sum_order_cnt,
              CAST(sum(paid_order_cnt) AS BIGINT) AS sum_paid_order_cnt
       FROM r_overview GROUP BY dt""",
)
def materialized_overview(t):
    """The roll-up written as a table and served from it."""
    path = work_path(t.spark, "mv_trade_overview")
    view = r.mv_trade_overview(r.ads_trade_overview_di(orders(t)))
    view.write.parquet(path)
    return read_table(t.spark, path, view.schema)


@query(
    "overwrite_partitions",
    ("r_users",),
    """SELECT dt, register_channel, count(*) AS new_user_cnt
       FROM (SELECT register_date AS dt, CASE WHEN register_date >= '20240115' THEN 'moved' ELSE register_channel END AS register_channel
             FROM r_users)
       GROUP BY dt, register_channel""",
)
def partition_overwrite(t):
    """A day that is loaded again replaces that day only."""
    table = RETAIL["dws_user_growth_day"]
    path = work_path(t.spark, "growth")
    first = users(t)
    again = first.where("register_date >= '20240115'").withColumn("register_channel", F.lit("moved"))
    overwrite_partitions(r.dws_user_growth_day(first), path, table)
    overwrite_partitions(r.dws_user_growth_day(again), path, table)
    return apply_contract(read_table(t.spark, path, table.schema), table)


@query(
    "sum_case_when",
    ("r_dwd",),
    """SELECT dt, CAST(sum(CASE WHEN order_status = 'paid' THEN 1 ELSE 0 END) AS BIGINT) AS paid_cnt,
              CAST(sum(CASE WHEN order_status = 'refunded' THEN order_amount ELSE 0 END) AS DOUBLE) AS refunded_amount
       FROM r_dwd GROUP BY dt""",
)
def conditional_sums(t):
    status = F.col("order_status")
    return orders(t).groupBy("dt").agg(
        count_if(status == "paid").alias("paid_cnt"), sum_if(status == "refunded", "order_amount").alias("refunded_amount")
    )


@query(
    "count_distinct_case",
    ("r_dwd",),
    """SELECT province, count(DISTINCT CASE WHEN order_status = 'paid' THEN user_id END) AS paid_users
       FROM r_dwd GROUP BY province""",
)
def conditional_distinct(t):
    return orders(t).groupBy("province").agg(distinct_if(F.col("order_status") == "paid", "user_id").alias("paid_users"))
