"""Checked queries of the sources: event payloads, change rows, generated rows, ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom import bindings as b
from tallyloom.contracts import MARKETPLACE, ORDER_MESSAGE, Table
from tallyloom.operators.keyed import upsert
from tallyloom.operators.joins import number_rows
from tallyloom.registry.base import query
from tallyloom.registry.sql import clock
from tallyloom.session import discard, stored
from tallyloom.sources import cdc, events, tables

NO_NULLS = {"ignoreNullFields": "false"}


def as_json(df, *columns):
    """The landed topic: one JSON text per row."""
    return stored(df.select(F.to_json(F.struct(*columns)).alias("value")), "topic")


def clock_text(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def raw_clicks(t):
    """Events as JSON text; error events are cut short, click events carry a word for their value."""
    word = F.when(F.col("event_type") == "click", F.lit("many")).otherwise(F.col("value").cast("string"))
    body = F.to_json(
        F.struct("event_id", "user_id", "event_type", word.alias("value"), clock_text("ts").alias("event_time"))
    )
    cut = F.when(F.col("event_type") == "error", F.substring(body, 1, 20)).otherwise(body)
    return stored(b.clicks(t).select("event_id", cut.alias("value")), "topic")


CLICK = Table(
    "clicks",
    "event_id bigint, user_id bigint, event_type string, value decimal(18,2), session_id string, event_time timestamp",
    ("event_id",),
)


@query(
    "ods_json_decode",
    (),
    """SELECT event_id, user_id, event_type, CASE WHEN event_type <> 'click' THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS value,
              CAST(NULL AS VARCHAR) AS session_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time
       FROM events WHERE event_type <> 'error'""",
)
def json_decode(t):
    return events.decode(raw_clicks(t), CLICK.schema)


MESSAGE = Table("messages", ORDER_MESSAGE, ("order_id",))


def raw_messages(t):
    """Nested order messages as JSON, timestamps the ISO way."""
    iso = F.date_format("create_time", "yyyy-MM-dd'T'HH:mm:ss")
    parcels = b.parcel_messages(t).withColumn("create_time", iso)
    return as_json(parcels, *parcels.columns)


PARCEL_HEAD = f"""SELECT order_id, shop_id, buyer_uid, CAST(total_pay_amount AS DOUBLE) AS total_pay_amount, total_quantity,
                         pay_status, {clock("create_time")},
                         CASE WHEN total_quantity = 1 THEN -1 WHEN total_quantity = 2 THEN 0
                              WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS item_cnt,
                         CASE WHEN total_quantity > 2 THEN CAST(pay AS DOUBLE) END AS first_pay_amount,
                         CASE WHEN total_quantity > 2 THEN line_id END AS first_item_id
                  FROM parcels"""


def message_summary(df):
    return df.select(
        "order_id",
        "shop_id",
        "buyer_uid",
        "total_pay_amount",
        "total_quantity",
        "pay_status",
        "create_time",
        # Of a line only these two fields are named, so that no others are read from a table or shuffled.
        F.coalesce(F.size("items.order_item_id"), F.lit(-1)).alias("item_cnt"),
        F.get("items.pay_amount", F.lit(0)).alias("first_pay_amount"),
        F.get("items.order_item_id", F.lit(0)).alias("first_item_id"),
    )


@query("ods_json_nested", ("parcels",), PARCEL_HEAD)
def json_nested(t):
    return message_summary(events.decode(raw_messages(t), MESSAGE.schema, events.ISO_CLOCK))


@query("ods_ingest_orders", ("parcels",), PARCEL_HEAD.replace("pay_status,", "'PAID' AS pay_status,"))
def ingest(t):
    """Messages into the keyed order table, which already holds every order unpaid.

    The messages are decoded once, for the table and for what arrives; their texts are deleted
    then.  Both are of one size, so the join that finds the untouched orders broadcasts neither; it
    is a join of the keys alone, as the orders that are replaced need not move.
    """
    messages = raw_messages(t)
    decoded = events.with_proc_time(events.decode(messages, MESSAGE.schema, events.ISO_CLOCK))
    rows = stored(decoded.select(*MARKETPLACE["ods_marketplace_order"].columns), "decoded")
    discard(messages.sparkSession, messages)
    held = rows.withColumn("pay_status", F.lit("UNPAID"))
    arriving = rows.withColumn("pay_status", F.lit("PAID")).hint("merge")
    return message_summary(upsert(held, arriving, ["order_id"], ["proc_time", "create_time"], keys_first=True))


@query(
    "ods_order_events",
    (),
    """SELECT CAST(l_orderkey AS VARCHAR) AS shop_order_id, CASE WHEN l_linestatus = 'F' THEN 5 ELSE 2 END AS order_status,
              CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * 100 AS BIGINT) AS order_amount,
              CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS DOUBLE) AS pay_amount,
              CAST(l_suppkey AS VARCHAR) AS sku_id, CAST(l_quantity AS INTEGER) AS item_num,
              strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS event_time
       FROM lineitem""",
)
def order_events(t):
    """Whole-number amounts in cents and a nested list of lines."""
    amount = (F.col("l_extendedprice").cast(b.MONEY) * 100).cast("bigint")
    line = F.struct(b.text("l_suppkey").alias("sku_id"), F.col("l_quantity").cast("int").alias("item_num"), amount.alias("pay_amount"))
    raw = as_json(
        t.lineitem,
        b.text("l_orderkey").alias("shop_order_id"),
        F.when(F.col("l_linestatus") == "F", 5).otherwise(2).alias("order_status"),
        amount.alias("order_amount"),
        amount.alias("pay_amount"),
        F.array(line).alias("sku_order_list"),
        clock_text("l_shipdate").alias("event_time"),
    )
    decoded = events.decode_event(raw, "order_events").withColumn("item", F.get("sku_order_list", F.lit(0)))
    whole = decoded.withColumn("cents", F.col("order_amount"))
    priced = events.order_event_amounts(whole, scale=100)
    return priced.select(
        "shop_order_id", "order_status", F.col("cents").alias("order_amount"), "pay_amount", "item.sku_id", "item.item_num", "event_time"
    )


@query(
    "ods_marketplace_events",
    ("heads",),
    f"""SELECT order_id AS tid, pay_status AS status, CAST(total_pay_amount AS DOUBLE) AS payment,
               CASE WHEN order_status <> 'P' THEN CAST(total_amount AS DOUBLE) END AS total_fee, receiver_province AS receiver_state,
               strftime(create_time, '%Y-%m-%d %H:%M:%S') AS event_time
        FROM heads""",
)
def marketplace_events(t):
    """Amounts arrive as text; the total of an open order is no number."""
    heads = b.order_heads(t, "region")
    total = F.when(F.col("order_status") != "P", F.col("total_amount").cast("string")).otherwise("pending")
    raw = as_json(
        heads,
        F.col("order_id").alias("tid"),
        F.col("pay_status").alias("status"),
        F.col("total_pay_amount").cast("string").alias("payment"),
        total.alias("total_fee"),
        F.col("receiver_province").alias("receiver_state"),
        clock_text("create_time").alias("event_time"),
    )
    decoded = events.marketplace_event_amounts(events.decode_event(raw, "marketplace_events"))
    return decoded.select("tid", "status", "payment", "total_fee", "receiver_state", "event_time")


@query(
    "ods_mall_events",
    ("lines",),
    """SELECT order_id, buyer_uid AS user_id, spu_id AS sku_id, quantity, CAST(item_amount AS DOUBLE) AS order_amount,
              CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(item_pay_amount AS DOUBLE) AS pay_amount, pay_status AS order_status
       FROM lines""",
)
def mall_events(t):
    raw = as_json(
        b.order_lines(t),
        "order_id",
        F.col("buyer_uid").alias("user_id"),
        F.col("spu_id").alias("sku_id"),
        "quantity",
        F.col("item_amount").alias("order_amount"),
        "discount_amount",
        F.col("item_pay_amount").alias("pay_amount"),
        F.col("pay_status").alias("order_status"),
    )
    return events.decode_event(raw, "mall_events").select(
        "order_id", "user_id", "sku_id", "quantity", "order_amount", "discount_amount", "pay_amount", "order_status"
    )


@query(
    "ods_behavior_events",
    (),
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, props AS referrer_info,
              strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time
       FROM events""",
)
def behavior_events(t):
    raw = as_json(
        b.clicks(t),
        b.text("event_id").alias("event_id"),
        "user_id",
        "event_type",
        F.col("props").alias("referrer_info"),
        clock_text("ts").alias("create_time"),
        clock_text("ts").alias("event_time"),
    )
    return events.decode_event(raw, "behavior_events").select(
        "event_id", "user_id", "event_type", "referrer_info", "create_time", "event_time"
    )


@query(
    "ods_ad_cost_events",
    (),
    """SELECT CAST(event_id AS VARCHAR) AS ad_id, event_type AS ad_type, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS cost_amount,
              user_id * 10 AS exposure_cnt, user_id AS click_cnt, strftime(ts, '%H') AS hour
       FROM events""",
)
def ad_cost_events(t):
    raw = as_json(
        b.clicks(t),
        F.col("event_id").alias("ad_id"),
        F.col("event_type").alias("ad_type"),
        F.col("value").alias("cost_amount"),
        (F.col("user_id") * 10).alias("exposure_cnt"),
        b.text("user_id").alias("click_cnt"),
        F.date_format("ts", "HH").alias("hour"),
    )
    return events.decode_event(raw, "ad_cost_events").select(
        "ad_id", "ad_type", "cost_amount", "exposure_cnt", "click_cnt", "hour"
    )


@query(
    "ods_inventory_events",
    (),
    """SELECT l_orderkey * 10 + l_linenumber AS log_id, CAST(l_partkey AS VARCHAR) AS sku_id, CAST(l_suppkey AS VARCHAR) AS warehouse_id,
              CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE -l_quantity END AS BIGINT) AS change_qty,
              CASE WHEN l_returnflag = 'R' THEN 'IN' ELSE 'OUT' END AS change_type
       FROM lineitem""",
)
def inventory_events(t):
    back = F.col("l_returnflag") == "R"
    units = F.col("l_quantity").cast("bigint")
    raw = as_json(
        t.lineitem,
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("log_id"),
        b.text("l_partkey").alias("sku_id"),
        b.text("l_suppkey").alias("warehouse_id"),
        F.when(back, units).otherwise(-units).alias("change_qty"),
        F.when(back, "IN").otherwise("OUT").alias("change_type"),
    )
    return events.decode_event(raw, "inventory_events").select("log_id", "sku_id", "warehouse_id", "change_qty", "change_type")


CHANGE_ROW = Table("accounts", "id bigint, total_amount decimal(16,2), pay_status string, create_time timestamp", ("id",))
CHANGE_COLUMNS = ("id", "pay_status", "total_amount", "create_time")


def change_log(t):
    return b.changes(t).withColumn("create_time", F.date_trunc("second", "ts"))


@query(
    "cdc_encode",
    ("changes",),
    """SELECT CAST(id AS VARCHAR) AS key,
              CASE WHEN op = 'd' THEN '{"before":' || body || ',"after":null,"op":"d"}'
                   ELSE '{"before":null,"after":' || body || ',"op":"c"}' END AS value
       FROM (SELECT id, op, '{"id":' || CAST(id AS VARCHAR) || ',"pay_status":"' || pay_status || '","total_amount":' ||
                    CAST(total_amount AS VARCHAR) || ',"create_time":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"}' AS body
             FROM changes)""",
)
def cdc_encode(t):
    return cdc.encode_changes(change_log(t), CHANGE_COLUMNS, "id")


@query(
    "cdc_decode",
    ("changes",),
    """SELECT event_id, CASE WHEN op = 'd' THEN 'd' ELSE 'c' END AS op, id, CAST(total_amount AS DOUBLE) AS total_amount, pay_status,
              strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time
       FROM changes""",
)
def cdc_decode(t):
    return cdc.decode_changes(change_messages(t), CHANGE_ROW.schema, keep=["event_id"])


def change_messages(t):
    """The change rows as messages, with the number of the event they came from."""
    log = change_log(t)
    image = F.struct("id", "pay_status", "total_amount", clock_text("create_time").alias("create_time"))
    gone = F.col("op") == "d"
    envelope = F.struct(
        F.when(gone, image).alias("before"),
        F.when(~gone, image).alias("after"),
        F.when(gone, "d").otherwise("c").alias("op"),
    )
    return stored(log.select("event_id", F.to_json(envelope, NO_NULLS).alias("value")), "topic")


LAST_CHANGE = """SELECT id, op, pay_status, total_amount, ts FROM (
                     SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS rn FROM changes) WHERE rn = 1"""


@query(
    "cdc_apply",
    ("changes",),
    f"""SELECT c_custkey AS id, 'old' AS pay_status, CAST(CAST(c_acctbal AS DECIMAL(16,2)) AS DOUBLE) AS total_amount
        FROM customer WHERE c_custkey NOT IN (SELECT id FROM changes)
        UNION ALL
        SELECT id, pay_status, CAST(total_amount AS DOUBLE) FROM ({LAST_CHANGE}) WHERE op <> 'd'""",
)
def apply_changes(t):
    held = t.customer.select(
        F.col("c_custkey").alias("id"), F.lit("old").alias("pay_status"), F.col("c_acctbal").cast(b.MONEY).alias("total_amount")
    )
    return cdc.cdc_apply(held, b.changes(t), ["id"], ["ts", "event_id"])


@query(
    "cdc_snapshot_then_changes",
    ("changes",),
    f"""SELECT id, pay_status, CAST(total_amount AS DOUBLE) AS total_amount FROM (
            SELECT c_custkey AS id, 'snapshot' AS pay_status, CAST(c_acctbal AS DECIMAL(16,2)) AS total_amount, 'r' AS op
            FROM customer WHERE c_custkey NOT IN (SELECT id FROM changes)
            UNION ALL SELECT id, pay_status, total_amount, op FROM ({LAST_CHANGE})) WHERE op <> 'd'""",
)
def snapshot_then_changes(t):
    snapshot = t.customer.select(
        F.col("c_custkey").alias("id"), F.lit("snapshot").alias("pay_status"), F.col("c_acctbal").cast(b.MONEY).alias("total_amount")
    )
    rows = cdc.snapshot_then_changes(snapshot, b.changes(t), ["id"], ["ts", "event_id"])
    return rows.select("id", "pay_status", "total_amount")


@query(
    "generate_orders",
    (),
    """SELECT seq AS id, 'DY20260820' || lpad(CAST(seq AS VARCHAR), CAST(greatest(length(CAST(seq AS VARCHAR)), 8) AS INTEGER), '0') AS order_id, 'DOUYIN' AS platform_code,
              'official' AS shop_id, 'buyer_' || lpad(CAST(seq AS VARCHAR), CAST(greatest(length(CAST(seq AS VARCHAR)), 6) AS INTEGER), '0') AS buyer_uid,
              CAST(2999 + CAST((seq * 7919) % 500000 AS DECIMAL(16,2)) / 100 AS DOUBLE) AS total_amount,
              CASE WHEN seq % 10 = 0 THEN 'UNPAID' ELSE 'PAID' END AS pay_status,
              strftime(DATE '2026-08-20' - CAST((seq * 31) % 7 AS INTEGER), '%Y-%m-%d %H:%M:%S') AS create_time
       FROM (SELECT o_orderkey + 1 AS seq FROM orders)""",
)
def generated(t):
    """As many generated orders as the order table has rows."""
    return tables.generate_orders(t.orders.select((F.col("o_orderkey") + 1).alias("seq")))


@query(
    "cross_join_numbers",
    (),
    """SELECT s_suppkey, CAST(a.i * 15 + b.i * 3 + c.i + 1 AS INTEGER) AS seq, a.v AS digit_1, b.v AS digit_2, c.v AS digit_3
       FROM supplier, (VALUES (0, 0), (1, 1), (2, 2), (3, 3), (4, 4)) a(i, v), (VALUES (0, 0), (1, 1), (2, 2), (3, 3), (4, 4)) b(i, v),
            (VALUES (0, 0), (1, 2), (2, 3)) c(i, v)""",
)
def numbered(t):
    """Every supplier with each combination of three digit lists."""
    five = range(5)
    return number_rows(t.supplier.select("s_suppkey"), [five, five, (0, 2, 3)])
