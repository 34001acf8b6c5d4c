"""Checked queries of the streams: each runs over the files it is given and compares with plain SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom import bindings as b
from tallyloom.plans import marketplace as m
from tallyloom.registry import sources as raw
from tallyloom.registry.base import query
from tallyloom.registry.sql import cents, clock, rounded
from tallyloom.session import exists, move, released_shuffles, work_path
from tallyloom.sources import cdc, events
from tallyloom.sources.tables import stream_table
from tallyloom.streaming import revising, windows
from tallyloom.streaming.keyed_log import KeyedLog, apply_change_log
from tallyloom.streaming.lookup import LookupJoin
from tallyloom.streaming.run import drain, each_batch, to_files

BATCHES = 4


def replayed(t, df, by, label: str, writer, placed=None) -> None:
    """Run the stream that ``writer`` makes over ``df``, which arrives in ``BATCHES`` micro-batches in the order of ``by``, a number or time.

    Slices of about equal size are landed one after the other, each in as many files as
    Spark writes, and the stream takes each as one batch.  The rows are written once, in a
    folder a slice; landing a slice renames its folder.  The slices are cut where ``placed``,
    by default ``df``, says: rows that arrive as those of ``df`` do and cost no joins.
    """
    with released_shuffles(t.spark):
        place = (F.col(by) if isinstance(by, str) else by).cast("double")
        placed = (df if placed is None else placed).select(place.alias("_by"))
        cuts = sorted(set(placed.approxQuantile("_by", [i / BATCHES for i in range(1, BATCHES)], 0.01)))
        number = F.lit(0)  # of rows without a place, too
        for cut in cuts:
            number = number + F.coalesce((place > cut).cast("int"), F.lit(0))
        path, checkpoint, waiting = (work_path(t.spark, name) for name in (label, "checkpoint", f"{label}-rows"))
        df.withColumn("_slice", number).write.partitionBy("_slice").parquet(waiting)
        for i in range(len(cuts) + 1):
            if exists(t.spark, f"{waiting}/_slice={i}"):
                move(t.spark, f"{waiting}/_slice={i}", f"{path}/slice-{i}")
            else:
                t.spark.createDataFrame([], df.schema).write.parquet(f"{path}/slice-{i}")
            drain(writer(stream_table(t.spark, f"{path}/slice-*", df.schema)), checkpoint)


@query(
    "stream_ingest",
    (),
    """SELECT event_id, user_id, event_type, CASE WHEN event_type <> 'click' THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS value,
              CAST(NULL AS VARCHAR) AS session_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time
       FROM events WHERE event_type <> 'error'""",
)
def ingest(t):
    """JSON events decoded and written to a keyed table."""
    table = KeyedLog(work_path(t.spark, "ods"), raw.CLICK.schema, ["event_id"], ["event_time"]).open_empty(t.spark)
    replayed(t, raw.raw_clicks(t), "event_id", "topic", lambda stream: each_batch(events.decode(stream, raw.CLICK.schema), table.append))
    return table.current(t.spark)


@query(
    "exactly_once_sink",
    ("versions",),
    """SELECT order_id, pay_status, CAST(total_pay_amount AS DOUBLE) AS total_pay_amount
       FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY proc_time DESC, pay_status DESC) AS rn FROM versions
             WHERE order_id IS NOT NULL AND total_pay_amount IS NOT NULL) WHERE rn = 1""",
)
def exactly_once(t):
    """Every batch is delivered twice, as after a failure between the write and its commit."""
    rows = m.drop_null_keys(b.order_versions(t), ["order_id", "total_pay_amount"]).select(
        "order_id", "pay_status", "total_pay_amount", "proc_time"
    )
    table = KeyedLog(work_path(t.spark, "orders"), rows.schema, ["order_id"], ["proc_time", "pay_status"]).open_empty(t.spark)

    def deliver_twice(batch, batch_id):
        table.append(batch, batch_id)
        table.append(batch, batch_id)

    replayed(t, rows, "proc_time", "versions", lambda stream: each_batch(stream, deliver_twice))
    return table.current(t.spark).drop("proc_time")


@query(
    "stream_watermark",
    (),
    f"SELECT event_id, user_id, event_type, {clock('ts').replace(' AS ts', ' AS event_time')} FROM events",
)
def watermark(t):
    """Events with the declared five seconds of disorder, appended to a table; no row is late for an append."""
    rows = t.events.select("event_id", "user_id", "event_type", F.col("ts").alias("event_time"))
    path = work_path(t.spark, "behavior")
    replayed(t, rows, "event_id", "events", lambda stream: to_files(events.with_event_watermark(stream), path))
    return t.spark.read.schema(rows.schema).parquet(path)


@query(
    "stream_window_counts",
    (),
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
              strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, event_type,
              count(*) AS n_events, count(value) AS n_values, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
       FROM events GROUP BY ALL""",
)
def windowed(t):
    """Hourly totals per kind of event.

    The events of the first three days come a second time at the end of the stream.  The
    watermark has passed their hours by then, so they change nothing.
    """
    events_in = t.events.select("event_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value"), F.col("ts").cast("timestamp").alias("event_time"))
    first = events_in.agg(F.min("event_time")).first()[0]
    late = events_in.where(F.col("event_time") < F.lit(first) + F.expr("INTERVAL 3 DAYS"))
    again = late.withColumn("arrival", F.col("event_time") + F.expr("INTERVAL 1000 DAYS"))
    rows = events_in.withColumn("arrival", F.col("event_time")).unionByName(again)
    totals = {"n_events": F.count(F.lit(1)), "n_values": F.count("value"), "total_value": F.sum("value")}

    def hourly(stream):
        return windows.window_totals(events.with_event_watermark(stream), "1 hour", ["event_type"], totals)

    table = windows.window_table(work_path(t.spark, "windows"), hourly(events_in), ["event_type"]).open_empty(t.spark)
    replayed(t, rows, "arrival", "events", lambda stream: windows.keep_totals(hourly(stream), table))
    return table.current(t.spark)


@query(
    "stream_lookup_join",
    (),
    """SELECT event_id, user_id, event_type,
              CASE WHEN event_id % 2 = 1 AND user_id % 3 = 0 THEN 'moved-' || c_mktsegment ELSE c_mktsegment END AS segment
       FROM events LEFT JOIN customer ON c_custkey = user_id AND (event_id % 2 = 0 OR user_id % 5 <> 1)""",
)
def looked_up(t):
    """Events with their user's segment as of the batch they come in.

    Events of even ids come first.  Then every third user moves to another segment and every fifth is withdrawn,
    and the other events come.
    """
    facts = t.events.select("event_id", "user_id", "event_type")
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    dim = KeyedLog(work_path(t.spark, "users"), users.schema, ["user_id"], [], by_arrival=True).open(users)
    join = LookupJoin(dim, "user_id", ["segment"], work_path(t.spark, "facts"))
    landing, checkpoint = work_path(t.spark, "landing"), work_path(t.spark, "checkpoint")

    def arrive(rest: int):
        facts.where(F.pmod("event_id", F.lit(2)) == rest).write.mode("append").parquet(landing)
        drain(each_batch(stream_table(t.spark, landing, facts.schema), join.process), checkpoint)

    arrive(0)
    moved = F.when(F.col("user_id") % 5 == 1, F.lit(None)).when(F.col("user_id") % 3 == 0, F.concat(F.lit("moved-"), "segment")).otherwise(F.col("segment"))
    dim.append(users.where("user_id % 3 = 0 OR user_id % 5 = 1").withColumn("segment", moved), 0)
    arrive(1)
    return join.result(t.spark, facts.schema)


@query(
    "stream_dedup_events",
    (),
    """SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time FROM events""",
)
def events_once(t):
    """Every event is delivered three times within the declared delay; one row of each is kept, in bounded state."""
    sent = t.events.select("event_id", "event_type", F.col("ts").cast("timestamp").alias("event_time"))
    sent = sent.withColumn("_again", F.explode(F.array(F.lit(0), F.lit(2), F.lit(4))))
    sent = sent.withColumn("arrival", F.col("event_time") + F.make_dt_interval(secs=F.col("_again"))).drop("_again")
    path = work_path(t.spark, "once")
    replayed(t, sent, "arrival", "events", lambda stream: to_files(events.drop_repeats(events.with_event_watermark(stream), ["event_id"]).drop("arrival"), path))
    return t.spark.read.schema(sent.drop("arrival").schema).parquet(path)


@query(
    "stream_explode",
    ("parcel_lines",),
    """SELECT order_id, order_item_id, spu_id, quantity, CAST(item_pay_amount AS DOUBLE) AS item_pay_amount FROM parcel_lines""",
)
def exploded(t):
    def lines(messages):
        return m.order_detail(messages).select("order_id", "order_item_id", "spu_id", "quantity", "item_pay_amount")

    messages, path = b.parcel_messages(t), work_path(t.spark, "detail")
    replayed(t, messages, "create_time", "messages", lambda stream: to_files(lines(stream), path))
    return t.spark.read.schema(lines(messages).schema).parquet(path)


@query(
    "stream_dedup",
    ("versions",),
    """SELECT order_id, shop_id, buyer_uid, pay_status, CAST(total_pay_amount AS DOUBLE) AS total_pay_amount, order_date
       FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY proc_time DESC, pay_status DESC) AS rn FROM versions
             WHERE order_id IS NOT NULL AND total_pay_amount IS NOT NULL) WHERE rn = 1""",
)
def dedup(t):
    """The batch cleaning step on each micro-batch, and the latest version over all of them."""
    versions = b.order_versions(t)
    schema = m.dwd_order(versions).schema
    table = KeyedLog(work_path(t.spark, "dwd"), schema, ["order_id"], list(m.VERSION_ORDER)).open_empty(t.spark)
    replayed(t, versions, "proc_time", "versions", lambda stream: each_batch(stream, lambda batch, n: table.append(m.dwd_order(batch), n)))
    return table.current(t.spark).select("order_id", "shop_id", "buyer_uid", "pay_status", "total_pay_amount", "order_date")


@query(
    "stream_cdc_apply",
    ("changes",),
    f"SELECT id, pay_status, CAST(total_amount AS DOUBLE) AS total_amount FROM ({raw.LAST_CHANGE}) WHERE op <> 'd'",
)
def stream_changes(t):
    """Change messages decoded and folded into the table; the last change of a key wins."""
    log = raw.change_log(t)
    messages = log.select("event_id", "ts").join(raw.change_messages(t), "event_id")
    schema = T.StructType.fromDDL(
        "event_id bigint, ts timestamp, op string, id bigint, total_amount decimal(16,2), pay_status string, create_time timestamp"
    )
    table = KeyedLog(work_path(t.spark, "accounts"), schema, ["id"], ["ts", "event_id"]).open_empty(t.spark)

    def decoded(stream):
        return cdc.decode_changes(stream, raw.CHANGE_ROW.schema, keep=["event_id", "ts"])

    replayed(t, messages, "ts", "changes", lambda stream: each_batch(decoded(stream), table.append))
    return apply_change_log(table, t.spark).select("id", "pay_status", "total_amount")


# Orders come in two versions: an open order is paid later, a finished one moves to
# another shop, and an order on its way is called off.
def revised_orders(t, *parts: str):
    heads = b.order_heads(t, *parts).withColumn("_round", F.explode(F.array(F.lit(0), F.lit(1))))
    again, status = F.col("_round") == 1, F.col("order_status")
    moved = ((F.col("order_id").cast("bigint") + 3) % 10).cast("string")
    return heads.withColumns(
        {
            "proc_time": F.col("proc_time") + F.expr("INTERVAL 400 DAYS") * F.col("_round"),
            "shop_id": F.when(again & (status == "F"), moved).otherwise(F.col("shop_id")),
            "pay_status": F.when(again & (status == "O"), "UNPAID").when(again, "PAID").otherwise(F.col("pay_status")),
        }
    ).drop("_round")


REVISED = """(SELECT * REPLACE (CASE WHEN order_status = 'F' THEN CAST((o_orderkey + 3) % 10 AS VARCHAR) ELSE shop_id END AS shop_id)
              FROM heads WHERE order_status <> 'O')"""


def revise(t, summary, rows, keys, order_by, by, placed):
    """The log holds of each row what the summary and the keys need."""
    needed = rows.select([c for c in rows.columns if c in {*keys, *order_by, *summary.reads}])
    table = KeyedLog(work_path(t.spark, "rows"), needed.schema, keys, order_by, part=summary.part(revising.YEAR), gather=False).open_empty(t.spark)
    kept = revising.RevisingSummary(summary, table, work_path(t.spark, summary.table.name), b.PAID)
    replayed(t, rows, by, "versions", lambda stream: each_batch(stream, kept.process), placed)
    return kept.result(t.spark)


def revise_orders(t, summary):
    return revise(t, summary, revised_orders(t, "shop", "quantity"), ["order_id"], ["proc_time"], "proc_time", revised_orders(t))


@query(
    "stream_upsert_agg",
    ("heads",),
    f"""SELECT shop_id, max(shop_name) AS shop_name, order_date AS stat_date, count(DISTINCT order_id) AS order_cnt,
               count(DISTINCT buyer_uid) AS buyer_uv, CAST(sum(total_pay_amount) AS DOUBLE) AS gmv,
               CAST(sum(total_discount_amount) AS DOUBLE) AS discount_amt, CAST(sum(freight_amount) AS DOUBLE) AS freight_amt,
               CAST(sum(total_pay_amount - freight_amount) AS DOUBLE) AS net_pay_amt,
               {rounded(cents("sum(total_pay_amount)"), "count(DISTINCT order_id)", 2)} AS avg_order_amount,
               CAST(sum(total_quantity) AS BIGINT) AS total_quantity
        FROM {REVISED} GROUP BY shop_id, order_date""",
)
def shops_kept(t):
    return revise_orders(t, revising.SHOP)


@query(
    "stream_upsert_buyers",
    ("heads",),
    f"""SELECT order_date AS stat_date, count(DISTINCT buyer_uid) AS buyer_uv, count(DISTINCT buyer_uid) AS new_buyer_uv,
               count(DISTINCT order_id) AS order_cnt, CAST(sum(total_pay_amount) AS DOUBLE) AS gmv,
               {rounded("100 * count(DISTINCT order_id)", "count(DISTINCT buyer_uid)", 2)} AS avg_orders_per_user,
               {rounded(cents("sum(total_pay_amount)"), "count(DISTINCT buyer_uid)", 2)} AS avg_gmv_per_user
        FROM {REVISED} GROUP BY order_date""",
)
def buyers_kept(t):
    return revise_orders(t, revising.BUYER)


# Lines of large amounts are called off in a second version.
def versions(lines):
    both = F.when(F.col("item_pay_amount") > 40000, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return lines.withColumn("version", F.explode(both))


def revised_lines(t):
    lines = versions(b.order_lines(t, "product"))
    return lines.withColumn("pay_status", F.when(F.col("version") == 2, "UNPAID").otherwise(F.col("pay_status")))


LINE_KEYS = ["order_id", "order_item_id"]


def line_arrival():
    """First versions before second ones, and the lines of a version spread over its part of the stream."""
    return F.col("version") + F.pmod(F.xxhash64(*LINE_KEYS), F.lit(1000)) / 1000


def revise_lines(t, summary):
    return revise(t, summary, revised_lines(t), LINE_KEYS, ["version"], line_arrival(), versions(b.bare_lines(t)))


@query(
    "stream_upsert_spu",
    ("lines",),
    """SELECT spu_id, max(spu_name) AS spu_name, max(brand) AS brand, strftime(create_time, '%Y-%m-%d') AS stat_date,
              count(DISTINCT order_id) AS order_cnt, count(DISTINCT order_item_id) AS sku_sold_cnt,
              CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(item_pay_amount) AS DOUBLE) AS gmv,
              CAST(sum(discount_amount) AS DOUBLE) AS discount_amt, count(DISTINCT buyer_uid) AS buyer_uv
       FROM lines WHERE pay_status = 'PAID' AND item_pay_amount <= 40000 GROUP BY spu_id, strftime(create_time, '%Y-%m-%d')""",
)
def spus_kept(t):
    return revise_lines(t, revising.SPU)


@query(
    "stream_upsert_category",
    ("lines",),
    """SELECT company_category_id, max(company_category_path) AS company_category_path,
              strftime(create_time, '%Y-%m-%d') AS stat_date, count(DISTINCT order_id) AS order_cnt,
              CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(item_pay_amount) AS DOUBLE) AS gmv,
              CAST(sum(discount_amount) AS DOUBLE) AS discount_amt, count(DISTINCT buyer_uid) AS buyer_uv
       FROM lines WHERE pay_status = 'PAID' AND item_pay_amount <= 40000
       GROUP BY company_category_id, strftime(create_time, '%Y-%m-%d')""",
)
def categories_kept(t):
    return revise_lines(t, revising.CATEGORY)
