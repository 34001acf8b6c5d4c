"""Table contracts: columns, types, primary keys and partition columns.

A table is declared once and every write is cast to it, which is also where
decimals are rounded.  The declarations below are fixed values: names, types and
keys are what users of these tables query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.scalars import all_of


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def apply_contract(df: DataFrame, table: Table, check_keys: bool = False) -> DataFrame:
    """Select and cast to the table's columns; optionally fail on a NULL key."""
    columns = []
    for field in table.schema:
        value = F.col(field.name).cast(field.dataType)
        if check_keys and field.name in table.keys:
            message = F.lit(f"NULL in key column {table.name}.{field.name}")
            value = F.when(value.isNull(), F.raise_error(message).cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def split_null_keys(df: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """Rows with a whole key, and the quarantine of those without."""
    whole = all_of([F.col(k).isNotNull() for k in table.keys])
    return df.where(whole), df.where(~whole)


# --- fixed values: retail chain, dates as yyyyMMdd ---------------------------

RETAIL = {
    t.name: t
    for t in (
        Table("ods_user_info", "user_id string, user_name string, register_channel string, register_date string", ("user_id",)),
        Table("ods_product_info", "product_id string, product_name string, category_name string", ("product_id",)),
        Table(
            "ods_order_info",
            "order_id string, user_id string, product_id string, order_amount decimal(16,2), order_status string, "
            "province string, channel string, create_time timestamp, dt string",
            ("order_id",),
        ),
        Table("dwd_user_info", "user_id string, user_name string, register_channel string, register_date string", ("user_id",)),
        Table("dwd_product_info", "product_id string, product_name string, category_name string", ("product_id",)),
        Table(
            "dwd_order_info",
            "order_id string, user_id string, product_id string, order_amount decimal(16,2), order_status string, "
            "is_refunded int, province string, channel string, create_time timestamp, dt string",
            ("order_id",),
        ),
        Table(
            "dws_channel_order_day",
            "dt string, channel string, uv bigint, order_cnt bigint, paid_order_cnt bigint, gmv decimal(16,2), refund_cnt bigint",
            ("dt", "channel"),
            ("dt",),
        ),
        Table(
            "dws_province_order_day",
            "dt string, province string, order_cnt bigint, paid_order_cnt bigint, paid_user_cnt bigint, gmv decimal(16,2)",
            ("dt", "province"),
            ("dt",),
        ),
        Table(
            "dws_product_sales_day",
            "dt string, product_id string, product_name string, category_name string, sale_cnt bigint, sale_amount decimal(16,2)",
            ("dt", "product_id"),
            ("dt",),
        ),
        Table("dws_user_growth_day", "dt string, register_channel string, new_user_cnt bigint", ("dt", "register_channel"), ("dt",)),
        Table(
            "ads_trade_overview_di",
            "dt string, total_order_cnt bigint, paid_order_cnt bigint, total_gmv decimal(16,2), paid_user_cnt bigint",
            ("dt",),
            ("dt",),
        ),
        Table(
            "ads_channel_conversion_di",
            "dt string, channel string, visit_uv bigint, order_cnt bigint, paid_order_cnt bigint, gmv decimal(16,2), "
            "order_conversion_rate decimal(16,4), pay_conversion_rate decimal(16,4)",
            ("dt", "channel"),
            ("dt",),
        ),
        Table(
            "ads_region_gmv_di",
            "dt string, province string, order_cnt bigint, paid_order_cnt bigint, paid_user_cnt bigint, gmv decimal(16,2)",
            ("dt", "province"),
            ("dt",),
        ),
        Table(
            "ads_product_sales_rank_di",
            "dt string, product_id bigint, product_name string, category_name string, sale_cnt bigint, sale_amount decimal(16,2)",
            ("dt", "product_id"),
            ("dt",),
        ),
        Table("ads_user_growth_di", "dt string, register_channel string, new_user_cnt bigint", ("dt", "register_channel"), ("dt",)),
    )
}

# --- fixed values: marketplace chain, dates as yyyy-MM-dd --------------------

ORDER_HEAD = (
    "order_id string, platform_code string, platform_name string, shop_id string, shop_name string, "
    "buyer_uid string, buyer_nick string, receiver_name string, receiver_phone string, receiver_province string, "
    "receiver_city string, receiver_district string, receiver_address string, total_amount decimal(16,2), "
    "total_discount_amount decimal(16,2), total_pay_amount decimal(16,2), total_quantity int, "
    "freight_amount decimal(16,2), order_status string, pay_status string, pay_time timestamp, create_time timestamp"
)
ORDER_ITEM = (
    "order_item_id string, outer_id string, platform_sku_id string, sku_name string, spu_id string, spu_name string, "
    "brand string, quantity int, unit string, unit_price decimal(16,2), item_amount decimal(16,2), "
    "discount_amount decimal(16,2), pay_amount decimal(16,2), platform_category_id string, "
    "platform_category_path string, platform_category_level int, company_category_id string, company_category_path string"
)
_ITEM_STRUCT = ", ".join(f"{name}: {kind}" for name, kind in (part.split(" ") for part in ORDER_ITEM.split(", ")))
ORDER_MESSAGE = f"{ORDER_HEAD}, items array<struct<{_ITEM_STRUCT}>>"

MARKETPLACE = {
    t.name: t
    for t in (
        Table("ods_marketplace_order", f"{ORDER_MESSAGE}, proc_time timestamp", ("order_id",)),
        Table("dwd_marketplace_order", f"{ORDER_HEAD}, order_date string, proc_time timestamp", ("order_id",)),
        Table(
            "dwd_marketplace_order_detail",
            "order_id string, platform_code string, platform_name string, shop_id string, shop_name string, "
            "buyer_uid string, buyer_nick string, order_status string, pay_status string, pay_time timestamp, "
            "create_time timestamp, order_item_id string, outer_id string, platform_sku_id string, sku_name string, "
            "spu_id string, spu_name string, brand string, quantity int, unit string, unit_price decimal(16,2), "
            "item_amount decimal(16,2), discount_amount decimal(16,2), item_pay_amount decimal(16,2), "
            "platform_category_id string, platform_category_path string, platform_category_level int, "
            "company_category_id string, company_category_path string, proc_time timestamp",
            ("order_id", "order_item_id"),
        ),
        Table(
            "dws_shop_daily_gmv",
            "shop_id string, shop_name string, stat_date string, order_cnt bigint, buyer_uv bigint, gmv decimal(16,2), "
            "discount_amt decimal(16,2), freight_amt decimal(16,2), net_pay_amt decimal(16,2), "
            "avg_order_amount decimal(16,2), total_quantity bigint",
            ("shop_id", "stat_date"),
        ),
        Table(
            "dws_spu_daily_sales",
            "spu_id string, spu_name string, brand string, stat_date string, order_cnt bigint, sku_sold_cnt bigint, "
            "quantity bigint, gmv decimal(16,2), discount_amt decimal(16,2), buyer_uv bigint",
            ("spu_id", "stat_date"),
        ),
        Table(
            "dws_category_daily_sales",
            "company_category_id string, company_category_path string, stat_date string, order_cnt bigint, "
            "quantity bigint, gmv decimal(16,2), discount_amt decimal(16,2), buyer_uv bigint",
            ("company_category_id", "stat_date"),
        ),
        Table(
            "dws_user_daily_activity",
            "stat_date string, buyer_uv bigint, new_buyer_uv bigint, order_cnt bigint, gmv decimal(16,2), "
            "avg_orders_per_user decimal(10,2), avg_gmv_per_user decimal(16,2)",
            ("stat_date",),
        ),
        Table(
            "ads_realtime_overview",
            "stat_date string, gmv decimal(16,2), order_cnt bigint, buyer_uv bigint, paid_order_cnt bigint, "
            "paid_gmv decimal(16,2), paid_buyer_uv bigint, discount_amt decimal(16,2), freight_amt decimal(16,2), "
            "avg_order_amount decimal(16,2)",
            ("stat_date",),
        ),
        Table(
            "ads_shop_rank_daily",
            "stat_date string, rank_no int, shop_id string, shop_name string, gmv decimal(16,2), order_cnt bigint, "
            "buyer_uv bigint, avg_order_amount decimal(16,2)",
            ("stat_date", "shop_id"),
        ),
        Table(
            "ads_top_spu_daily",
            "stat_date string, rank_no int, spu_id string, spu_name string, brand string, quantity bigint, "
            "gmv decimal(16,2), order_cnt bigint, buyer_uv bigint",
            ("stat_date", "spu_id"),
        ),
        Table(
            "cdc_order",
            "id bigint, order_id string, platform_code string, shop_id string, buyer_uid string, "
            "total_amount decimal(16,2), pay_status string, create_time timestamp",
            ("id",),
        ),
    )
}

# The seven tables the analyst layer serves.
SERVED = (
    "ads_realtime_overview",
    "ads_top_spu_daily",
    "ads_shop_rank_daily",
    "dws_shop_daily_gmv",
    "dws_spu_daily_sales",
    "dws_category_daily_sales",
    "dws_user_daily_activity",
)

# --- fixed values: event payloads -------------------------------------------

EVENTS = {
    t.name: t
    for t in (
        Table(
            "order_events",
            "shop_order_id string, create_time string, pay_time string, order_status int, order_status_desc string, "
            "order_amount bigint, pay_amount bigint, post_amount bigint, buyer_uid string, user_nick_name string, "
            "receiver_name string, receiver_mobile string, province string, city string, "
            "sku_order_list array<struct<sku_id: string, product_id: string, product_name: string, out_sku_id: string, "
            "item_num: int, goods_price: bigint, pay_amount: bigint, promotion_amount: bigint, room_id: string, "
            "video_id: string, author_id: string, author_name: string, content_id: string, first_cid: string, "
            "second_cid: string>>, event_time timestamp",
        ),
        Table(
            "marketplace_events",
            "tid string, oid string, status string, type string, payment string, total_fee string, discount_fee string, "
            "created string, pay_time string, buyer_open_uid string, buyer_nick string, receiver_state string, "
            "receiver_city string, receiver_district string, receiver_address string, receiver_mobile string, "
            "orders array<struct<oid: string, num_iid: string, title: string, price: string, num: int, payment: string, "
            "sku_id: string, outer_sku_id: string, refund_status: string>>, event_time timestamp",
        ),
        Table(
            "mall_events",
            "order_id string, user_id string, platform_id string, source_type string, scene string, sku_id string, "
            "outer_sku_id string, sku_name string, quantity int, order_amount decimal(18,2), "
            "discount_amount decimal(18,2), pay_amount decimal(18,2), coupon_id string, order_status string, "
            "create_time string, pay_time string, event_time timestamp",
        ),
        Table(
            "behavior_events",
            "event_id string, user_id string, session_id string, event_type string, page_path string, sku_id string, "
            "keyword string, scene string, referrer_info string, create_time string, event_time timestamp",
        ),
        Table(
            "ad_cost_events",
            "ad_id string, platform_id string, ad_type string, cost_amount decimal(18,2), exposure_cnt bigint, "
            "click_cnt bigint, hour string, event_time timestamp",
        ),
        Table(
            "inventory_events",
            "log_id bigint, sku_id string, warehouse_id string, change_qty bigint, change_type string, "
            "biz_type string, biz_id string, create_time string, event_time timestamp",
        ),
    )
}

# --- fixed values: relational dimensions -------------------------------------

DIMENSIONS = {
    t.name: t
    for t in (
        Table(
            "crm_customer",
            "customer_id string, customer_name string, phone_mask string, gender tinyint, age_range string, "
            "province string, city string, source_channel string, member_level string, first_order_time timestamp, "
            "last_order_time timestamp, total_order_cnt int, total_gmv decimal(18,2), create_time timestamp, "
            "update_time timestamp",
            ("customer_id",),
        ),
        Table(
            "crm_customer_tag",
            "customer_id string, tag_name string, tag_category string, update_time timestamp",
            ("customer_id", "tag_name"),
        ),
        Table(
            "mkt_coupon_info",
            "coupon_id string, coupon_name string, coupon_type string, min_amount decimal(18,2), "
            "discount_amount decimal(18,2), start_time timestamp, end_time timestamp, total_count int, status tinyint",
            ("coupon_id",),
        ),
        Table(
            "mkt_activity_info",
            "activity_id string, activity_name string, activity_type string, start_time timestamp, "
            "end_time timestamp, platform_id string",
            ("activity_id",),
        ),
        Table(
            "erp_spu_info",
            "spu_id string, spu_name string, category_id string, category_name string, brand_id string, "
            "brand_name string, status tinyint, create_time timestamp",
            ("spu_id",),
        ),
        Table(
            "erp_sku_info",
            "sku_id string, sku_name string, spu_id string, spec_info string, unit string, cost_price decimal(18,2), "
            "sale_price decimal(18,2), status tinyint, taobao_outer_id string, taobao_sku_id string, "
            "douyin_outer_id string, douyin_sku_id string, mall_outer_id string, mall_sku_id string, "
            "is_bundle tinyint, bundle_id string",
            ("sku_id",),
        ),
        Table(
            "erp_bundle_info",
            "bundle_id string, bundle_name string, spu_id string, sale_mode string, sale_price decimal(18,2), status tinyint",
            ("bundle_id",),
        ),
        Table(
            "erp_bundle_detail",
            "bundle_id string, sku_id string, sku_type string, quantity int",
            ("bundle_id", "sku_id"),
        ),
        Table(
            "erp_inventory",
            "sku_id string, warehouse_id string, warehouse_name string, stock_qty bigint, available_qty bigint, "
            "reserved_qty bigint, update_time timestamp",
            ("sku_id", "warehouse_id"),
        ),
        Table(
            "erp_inventory_log",
            "log_id bigint, sku_id string, warehouse_id string, change_qty bigint, change_type string, "
            "biz_type string, biz_id string, create_time timestamp",
            ("log_id",),
        ),
    )
}

ALL = {**RETAIL, **MARKETPLACE, **EVENTS, **DIMENSIONS}
