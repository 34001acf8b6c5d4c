"""The ten-order example of the retail chain, with results worked out by hand."""

from decimal import Decimal as D

import pytest

from tallyloom.contracts import RETAIL
from tallyloom.plans import retail
from tallyloom.sources.tables import values_rows

# The users, products and orders of the golden case, as they are given.
USERS = [
    ("u1", "张三", "app", "20260720"),
    ("u2", "李四", "web", "20260720"),
    ("u3", "王五", "miniapp", "20260720"),
    ("u4", "赵六", "app", "20260721"),
    ("u5", "钱七", "web", "20260721"),
]
PRODUCTS = [("p1", "机械键盘", "电脑外设"), ("p2", "4K显示器", "电脑外设"), ("p3", "人体工学椅", "办公家具")]
ORDERS = [
    ("o1", "u1", "p1", 500, "paid", "广东", "app", "2026-07-20 10:00:00", "20260720"),
    ("o2", "u2", "p2", 1500, "paid", "北京", "web", "2026-07-20 11:00:00", "20260720"),
    ("o3", "u3", "p3", 800, "paid", "上海", "miniapp", "2026-07-20 12:00:00", "20260720"),
    ("o4", "u1", "p2", 1500, "refunded", "广东", "app", "2026-07-20 13:00:00", "20260720"),
    ("o5", "u4", "p1", 500, "paid", "广东", "app", "2026-07-20 14:00:00", "20260720"),
    ("o6", "u2", "p3", 800, "paid", "北京", "web", "2026-07-21 10:00:00", "20260721"),
    ("o7", "u5", "p1", 500, "paid", "上海", "web", "2026-07-21 11:00:00", "20260721"),
    ("o8", "u3", "p2", 1500, "paid", "上海", "miniapp", "2026-07-21 12:00:00", "20260721"),
    ("o9", "u4", "p3", 800, "refunded", "广东", "app", "2026-07-21 13:00:00", "20260721"),
    ("o10", "u1", "p1", 500, "paid", "广东", "app", "2026-07-21 14:00:00", "20260721"),
]


@pytest.fixture(scope="module")
def orders(spark):
    return retail.dwd_order_info(values_rows(spark, ORDERS, RETAIL["ods_order_info"]))


@pytest.fixture(scope="module")
def products(spark):
    return retail.dwd_product_info(values_rows(spark, PRODUCTS, RETAIL["ods_product_info"]))


def test_overview(orders, rows):
    assert rows(retail.ads_trade_overview_di(orders)) == [
        ("20260720", 5, 4, D("3300.00"), 4),
        ("20260721", 5, 4, D("3300.00"), 4),
    ]


def test_refund_flag(orders, rows):
    assert [r for r in rows(orders, "order_id", "is_refunded") if r[1]] == [("o4", 1), ("o9", 1)]


def test_channels(orders, rows):
    channels = retail.dws_channel_order_day(orders)
    assert rows(channels) == [
        ("20260720", "app", 2, 3, 2, D("1000.00"), 1),
        ("20260720", "miniapp", 1, 1, 1, D("800.00"), 0),
        ("20260720", "web", 1, 1, 1, D("1500.00"), 0),
        ("20260721", "app", 2, 2, 1, D("500.00"), 1),
        ("20260721", "miniapp", 1, 1, 1, D("1500.00"), 0),
        ("20260721", "web", 2, 2, 2, D("1300.00"), 0),
    ]
    rates = rows(retail.ads_channel_conversion_di(channels), "dt", "channel", "visit_uv", "order_conversion_rate", "pay_conversion_rate")
    assert rates[0] == ("20260720", "app", 20, D("0.1500"), D("0.1000"))
    assert rates[3] == ("20260721", "app", 20, D("0.1000"), D("0.0500"))


def test_provinces(orders, rows):
    provinces = retail.dws_province_order_day(orders)
    assert rows(retail.ads_region_gmv_di(provinces)) == [
        ("20260720", "上海", 1, 1, 1, D("800.00")),
        ("20260720", "北京", 1, 1, 1, D("1500.00")),
        ("20260720", "广东", 3, 2, 2, D("1000.00")),
        ("20260721", "上海", 2, 2, 2, D("2000.00")),
        ("20260721", "北京", 1, 1, 1, D("800.00")),
        ("20260721", "广东", 2, 1, 1, D("500.00")),
    ]


def test_products(orders, products, rows):
    sales = retail.dws_product_sales_day(orders, products)
    assert rows(sales, "dt", "product_id", "product_name", "sale_cnt", "sale_amount") == [
        ("20260720", "p1", "机械键盘", 2, D("1000.00")),
        ("20260720", "p2", "4K显示器", 2, D("3000.00")),
        ("20260720", "p3", "人体工学椅", 1, D("800.00")),
        ("20260721", "p1", "机械键盘", 2, D("1000.00")),
        ("20260721", "p2", "4K显示器", 1, D("1500.00")),
        ("20260721", "p3", "人体工学椅", 2, D("1600.00")),
    ]
    published, quarantine = retail.ads_product_sales_rank_di(sales)
    assert published.count() == 0
    assert rows(quarantine, "product_id", "sale_cnt")[0] == ("p1", 2)
    assert quarantine.count() == 6


def test_growth(spark, rows):
    users = retail.dwd_user_info(values_rows(spark, USERS, RETAIL["ods_user_info"]))
    assert rows(retail.ads_user_growth_di(retail.dws_user_growth_day(users))) == [
        ("20260720", "app", 1),
        ("20260720", "miniapp", 1),
        ("20260720", "web", 1),
        ("20260721", "app", 1),
        ("20260721", "web", 1),
    ]


def test_rollup(spark, rows):
    days = [("20260714", 1200, 980, 125000, 850), ("20260715", 1350, 1100, 138000, 920)]
    view = retail.mv_trade_overview(values_rows(spark, days, RETAIL["ads_trade_overview_di"]))
    assert rows(view) == [("20260714", D("125000.00"), 1200, 980), ("20260715", D("138000.00"), 1350, 1100)]


def test_amount_must_be_positive(spark):
    odd = [("a", "u", "p", None, "paid", "广东", "app", None, "20260720"), ("b", "u", "p", 0, "paid", "广东", "app", None, "20260720")]
    assert retail.dwd_order_info(values_rows(spark, odd, RETAIL["ods_order_info"])).count() == 0
