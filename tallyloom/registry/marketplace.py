"""Checked queries of the marketplace chain: facts, daily summaries and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom import bindings as b
from tallyloom.functions.scalars import day_text
from tallyloom.operators.filters import filter_paid
from tallyloom.operators.keyed import drop_null_keys
from tallyloom.operators.ranking import first_within
from tallyloom.plans import marketplace as m
from tallyloom.registry.base import query
from tallyloom.registry.sql import clock, doubles

SHOP_MONEY = ("gmv", "discount_amt", "freight_amt", "net_pay_amt")
ITEM_MONEY = ("gmv", "discount_amt")


def shops(t):
    return m.dws_shop_daily_gmv(b.order_heads(t, "shop", "quantity"), b.PAID)


def spus(t, keyed=True):
    return m.dws_spu_daily_sales(b.order_lines(t, "product"), b.PAID, keyed)


def categories(t):
    return m.dws_category_daily_sales(b.order_lines(t, "product"), b.PAID)


def buyers(t):
    return m.dws_user_daily_activity(b.order_heads(t), b.PAID)


def overview(t):
    return m.ads_realtime_overview(shops(t))


@query(
    "clean_null_keys",
    ("versions",),
    """SELECT order_id, CAST(total_pay_amount AS DOUBLE) AS total_pay_amount, pay_status FROM versions
       WHERE order_id IS NOT NULL AND total_pay_amount IS NOT NULL""",
)
def clean(t):
    rows = b.order_versions(t).select("order_id", "total_pay_amount", "pay_status")
    return drop_null_keys(rows, ["order_id", "total_pay_amount"])


@query(
    "filter_paid",
    ("heads",),
    "SELECT order_id, shop_id, CAST(total_pay_amount AS DOUBLE) AS total_pay_amount FROM heads WHERE pay_status = 'PAID'",
)
def paid(t):
    return filter_paid(b.order_heads(t), b.PAID).select("order_id", "shop_id", "total_pay_amount")


@query("derive_order_date", ("heads",), "SELECT order_id, strftime(create_time, '%Y-%m-%d') AS order_date FROM heads")
def order_date(t):
    return b.order_heads(t).select("order_id", day_text("create_time").alias("order_date"))


@query(
    "dwd_order_dedup",
    ("versions",),
    f"""SELECT order_id, shop_id, shop_name, buyer_uid, buyer_nick, receiver_province,
               CAST(total_amount AS DOUBLE) AS total_amount, CAST(total_discount_amount AS DOUBLE) AS total_discount_amount,
               CAST(total_pay_amount AS DOUBLE) AS total_pay_amount, total_quantity,
               CAST(freight_amount AS DOUBLE) AS freight_amount, order_status, pay_status, {clock("create_time")},
               order_date, strftime(seen, '%Y-%m-%d %H:%M:%S') AS proc_time
        FROM (SELECT * RENAME (proc_time AS seen),
                     row_number() OVER (PARTITION BY order_id ORDER BY proc_time DESC, pay_status DESC) AS rn
              FROM versions WHERE order_id IS NOT NULL AND total_pay_amount IS NOT NULL)
        WHERE rn = 1""",
)
def dedup(t):
    return m.dwd_order(b.order_versions(t, "shop", "buyer", "region", "quantity"))


@query(
    "dwd_order_detail",
    ("parcel_lines",),
    f"""SELECT * REPLACE (CAST(item_amount AS DOUBLE) AS item_amount, CAST(discount_amount AS DOUBLE) AS discount_amount,
                          CAST(item_pay_amount AS DOUBLE) AS item_pay_amount, {clock("create_time")})
        FROM parcel_lines""",
)
def detail(t):
    return m.order_detail(b.parcel_messages(t))


@query(
    "struct_field_access",
    ("parcel_lines",),
    """SELECT order_id, order_item_id, quantity, CAST(item_pay_amount AS DOUBLE) AS item_pay_amount FROM parcel_lines""",
)
def fields(t):
    lines = b.parcel_messages(t).select("order_id", F.explode("items").alias("item"))
    return lines.select(
        "order_id", "item.order_item_id", "item.quantity", F.col("item.pay_amount").alias("item_pay_amount")
    )


@query("dws_shop_daily_gmv", ("shops",), doubles("shops", *SHOP_MONEY))
def shop_day(t):
    return shops(t)


@query("dws_spu_daily_sales", ("spus",), doubles("spus", *ITEM_MONEY))
def spu_day(t):
    return spus(t)


@query("dws_category_daily_sales", ("categories",), doubles("categories", *ITEM_MONEY))
def category_day(t):
    return categories(t)


@query("dws_user_daily_activity", ("buyers",), doubles("buyers", "gmv"))
def buyer_day(t):
    return buyers(t)


@query(
    "new_buyer_uv_exact",
    ("heads",),
    """SELECT stat_date, count(*) AS buyer_uv, count(*) FILTER (stat_date = since) AS new_buyer_uv,
              round(count(*) FILTER (stat_date = since) / count(*), 4) AS new_buyer_share
       FROM (SELECT DISTINCT buyer_uid, order_date AS stat_date, min(order_date) OVER (PARTITION BY buyer_uid) AS since
             FROM heads WHERE pay_status = 'PAID' AND buyer_uid IS NOT NULL) GROUP BY stat_date""",
)
def new_buyers(t):
    return m.new_buyers_exact(b.order_heads(t), b.PAID)


@query(
    "overview_exact_uv",
    ("heads", "shops"),
    """SELECT stat_date, buyer_uv, buyer_uv_by_shop
       FROM (SELECT order_date AS stat_date, count(DISTINCT buyer_uid) AS buyer_uv FROM heads WHERE pay_status = 'PAID' GROUP BY order_date)
       LEFT JOIN (SELECT stat_date, CAST(sum(buyer_uv) AS BIGINT) AS buyer_uv_by_shop FROM shops GROUP BY stat_date) USING (stat_date)""",
)
def exact_buyers(t):
    heads = b.order_heads(t)
    return m.overview_exact_buyers(heads, shops(t), b.PAID)


@query("ads_realtime_overview", ("overview",), doubles("overview", "gmv", "paid_gmv", "discount_amt", "freight_amt"))
def realtime_overview(t):
    return overview(t)


@query("ads_shop_rank_daily", ("shop_rank",), doubles("shop_rank", "gmv"))
def shop_rank(t):
    return m.ads_shop_rank_daily(shops(t))


@query("ads_top_spu_daily", ("spu_rank",), doubles("spu_rank", "gmv"))
def spu_rank(t):
    return m.ads_top_spu_daily(spus(t))


@query(
    "rank_first",
    ("shop_rank",),
    "SELECT stat_date, rank_no, shop_id, CAST(gmv AS DOUBLE) AS gmv FROM shop_rank WHERE rank_no = 1",
)
def best_shop(t):
    return first_within(shops(t), "stat_date", "gmv", "shop_id").select("stat_date", "rank_no", "shop_id", "gmv")


@query(
    "agg_max_any",
    ("lines",),
    "SELECT spu_id, max(spu_name) AS spu_name, max(brand) AS brand FROM lines GROUP BY spu_id",
)
def carried_names(t):
    lines = b.order_lines(t, "product")
    return lines.groupBy("spu_id").agg(F.max("spu_name").alias("spu_name"), F.max("brand").alias("brand"))


@query(
    "group_by_expression",
    ("lines",),
    """SELECT strftime(create_time, '%Y-%m-%d') AS stat_date, CAST(sum(quantity) AS BIGINT) AS quantity
       FROM lines GROUP BY strftime(create_time, '%Y-%m-%d')""",
)
def by_day(t):
    return b.order_lines(t).groupBy(day_text("create_time").alias("stat_date")).agg(F.sum("quantity").alias("quantity"))


@query("count_rows", ("parcel_lines",), "SELECT count(*) AS total_detail_rows FROM parcel_lines")
def row_count(t):
    return m.order_detail(b.parcel_messages(t)).agg(F.count(F.lit(1)).alias("total_detail_rows"))
