"""Views that present the bundled test tables as the warehouse's inputs.

The tables have no shops, channels or nested lines, so these views define them.
``registry/sql.py`` holds the same definitions as SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(16,2)"
PAID = ("PAID",)


class Tables:
    """The Parquet tables of one scale folder, opened on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def text(column: str):
    return F.col(column).cast("string")


def head_columns():
    """What an order alone tells, by name."""
    key = F.col("o_orderkey")
    return {
        "order_id": text("o_orderkey"),
        "shop_id": (key % 10).cast("string"),
        "buyer_uid": text("o_custkey"),
        "total_pay_amount": F.col("o_totalprice").cast(MONEY),
        "freight_amount": F.when(key % 50 != 0, (key % 7 + 5).cast(MONEY)),
        "total_discount_amount": (key % 13).cast(MONEY),
        "total_amount": (F.col("o_totalprice").cast(MONEY) + (key % 13).cast(MONEY)).cast(MONEY),
        "pay_status": F.when(F.col("o_orderstatus").isin("F", "O"), "PAID").otherwise("UNPAID"),
        "order_status": F.col("o_orderstatus"),
        "create_time": F.col("o_orderdate").cast("timestamp"),
        "order_date": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "proc_time": F.timestamp_add("SECOND", (key % 86400).cast("int"), F.col("o_orderdate").cast("timestamp")),
    }


def order_heads(t: Tables, *parts: str) -> DataFrame:
    """Orders of the marketplace chain.

    ``parts`` names the look-ups to add: ``shop`` (name), ``buyer`` (nick name),
    ``region`` (province) and ``quantity`` (units per order).  A report that does
    not read them does not pay for the join.
    """
    columns = [c.alias(name) for name, c in head_columns().items()]
    orders = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 10).alias("s_suppkey"), *columns)
    if "shop" in parts:
        orders = orders.join(t.supplier.select("s_suppkey", F.col("s_name").alias("shop_name")), "s_suppkey", "left")
    if "buyer" in parts or "region" in parts:
        customers = t.customer.select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("buyer_nick"), "c_nationkey"
        )
        orders = orders.join(customers, "o_custkey", "left")
        if "region" in parts:
            nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("receiver_province"))
            orders = orders.join(nations, "c_nationkey", "left")
        orders = orders.drop("c_nationkey")
    if "quantity" in parts:
        units = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("_units"))
        orders = orders.join(units, "o_orderkey", "left").withColumn(
            "total_quantity", F.coalesce(F.col("_units"), F.lit(0)).cast("int")
        )
    return orders.drop("o_orderkey", "o_custkey", "s_suppkey", "_units")


def order_versions(t: Tables, *parts: str) -> DataFrame:
    """Order messages as they arrive: open orders come again an hour later as paid, some keys or amounts are missing."""
    number = F.col("order_id").cast("bigint")
    rounds = F.when(F.col("order_status") == "P", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    heads = order_heads(t, *parts).withColumn("_round", F.explode(rounds))
    return heads.withColumns(
        {
            "proc_time": F.col("proc_time") + F.expr("INTERVAL 1 HOUR") * F.col("_round"),
            "pay_status": F.when(F.col("_round") == 1, "PAID").otherwise(F.col("pay_status")),
            "total_pay_amount": F.when(number % 31 != 0, F.col("total_pay_amount")),
            "order_id": F.when(number % 41 != 0, F.col("order_id")),
        }
    ).drop("_round")


def line_id():
    """An id of a line built from the line alone, unique within its order."""
    return F.concat_ws(
        "-",
        text("l_linenumber"),
        text("l_partkey"),
        text("l_suppkey"),
        (F.col("l_extendedprice").cast(MONEY) * 100).cast("bigint").cast("string"),
        F.col("l_quantity").cast("int").cast("string"),
        F.date_format("l_shipdate", "yyyyMMdd"),
    )


def line_columns():
    """What an order line alone tells."""
    amount = F.col("l_extendedprice").cast(MONEY)
    discount = (amount * F.col("l_discount").cast("decimal(4,2)")).cast(MONEY)
    return [
        text("l_orderkey").alias("order_id"),
        line_id().alias("order_item_id"),
        text("l_partkey").alias("spu_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        amount.alias("item_amount"),
        discount.alias("discount_amount"),
        (amount - discount).cast(MONEY).alias("item_pay_amount"),
    ]


def bare_lines(t: Tables) -> DataFrame:
    """Order lines without what is known of their order and product."""
    return t.lineitem.select(*line_columns())


def order_lines(t: Tables, *parts: str) -> DataFrame:
    """Order lines with their order's buyer, day and status; ``product`` adds names, brand and category.

    The stored numbers are joined and become texts afterwards, as texts take twice the room in a shuffle.
    """
    numbers = {"l_quantity": "int", "l_extendedprice": MONEY, "l_discount": "decimal(4,2)"}
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", *(F.col(c).cast(kind).alias(c) for c, kind in numbers.items()))
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    lines, heads, names = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), head_columns(), []
    if "product" in parts:
        products = t.part.select(
            "p_partkey",
            F.col("p_name").alias("spu_name"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("company_category_id"),
            F.concat_ws(">", "p_type", "p_brand", "p_name").alias("company_category_path"),
        )
        lines, names = lines.join(products, F.col("l_partkey") == F.col("p_partkey"), "left"), products.columns[1:]
    return lines.select(*line_columns(), *(heads[c].alias(c) for c in ("shop_id", "buyer_uid", "pay_status", "create_time")), *names)


def parcel_messages(t: Tables) -> DataFrame:
    """Nested order messages, one parcel per order line, made without grouping.

    A returned line carries a gift line next to it; parcels of one unit have no
    ``items`` at all and parcels of two units an empty list.
    """
    amount = F.col("l_extendedprice").cast(MONEY)
    discount = (amount * F.col("l_discount").cast("decimal(4,2)")).cast(MONEY)
    base = t.lineitem.select(
        text("l_orderkey").alias("order_key"),
        text("l_suppkey").alias("supplier"),
        text("l_partkey").alias("part"),
        line_id().alias("line_id"),
        F.col("l_quantity").cast("int").alias("units"),
        amount.alias("amount"),
        discount.alias("discount"),
        "l_returnflag",
        "l_linestatus",
        F.col("l_shipdate").cast("timestamp").alias("create_time"),
    )

    def item(number, spu, units, full, less, paid, category):
        return F.struct(
            number.alias("order_item_id"),
            spu.alias("spu_id"),
            units.alias("quantity"),
            full.alias("item_amount"),
            less.alias("discount_amount"),
            paid.alias("pay_amount"),
            category.alias("company_category_id"),
        )

    c, nothing = F.col, F.lit(0).cast(MONEY)
    paid = (c("amount") - c("discount")).cast(MONEY)
    line = item(c("line_id"), c("part"), c("units"), c("amount"), c("discount"), paid, c("supplier"))
    gift = item(F.concat(F.lit("gift-"), "line_id"), c("supplier"), F.lit(1), nothing, nothing, nothing, F.lit("gift"))
    parcel = F.when(c("l_returnflag") == "R", F.array(line, gift)).otherwise(F.array(line))
    empty = F.array().cast("array<struct<order_item_id:string,spu_id:string,quantity:int,item_amount:decimal(16,2),"
                           "discount_amount:decimal(16,2),pay_amount:decimal(16,2),company_category_id:string>>")
    return base.select(
        F.concat_ws("/", "order_key", "line_id").alias("order_id"),
        c("supplier").alias("shop_id"),
        c("order_key").alias("buyer_uid"),
        c("amount").alias("total_pay_amount"),
        c("units").alias("total_quantity"),
        F.when(c("l_linestatus") == "F", "PAID").otherwise("UNPAID").alias("pay_status"),
        "create_time",
        F.when(c("units") == 1, F.lit(None)).when(c("units") == 2, empty).otherwise(parcel).alias("items"),
    )


def retail_orders(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    amount = F.col("o_totalprice").cast(MONEY)
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("province"))
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(nations, "c_nationkey", "left")
    # Known to be unique, the look-up disappears from plans that do not read the province.
    customers = customers.dropDuplicates(["o_custkey"])
    product = (key % 200).cast("string")
    return t.orders.join(customers, "o_custkey", "left").select(
        text("o_orderkey").alias("order_id"),
        text("o_custkey").alias("user_id"),
        F.when(key % 97 == 0, F.concat(F.lit("x"), product)).otherwise(product).alias("product_id"),
        F.when(key % 31 == 0, F.lit(None)).when(key % 37 == 0, F.lit(0).cast(MONEY)).otherwise(amount).alias("order_amount"),
        F.when(F.col("o_orderstatus") == "F", "paid")
        .when(F.col("o_orderstatus") == "O", "refunded")
        .otherwise("created")
        .alias("order_status"),
        "province",
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderdate").cast("timestamp").alias("create_time"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("dt"),
    )


def retail_products(t: Tables) -> DataFrame:
    """Products small enough to be listed; the large ones stay unknown to the look-up."""
    return t.part.where("p_size <= 45").select(
        text("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category_name")
    )


def retail_users(t: Tables) -> DataFrame:
    joined = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 28).cast("int"))
    return t.customer.select(
        text("c_custkey").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.col("c_mktsegment").alias("register_channel"),
        F.date_format(joined, "yyyyMMdd").alias("register_date"),
    )


def clicks(t: Tables) -> DataFrame:
    return t.events.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("value", F.col("value").cast(MONEY))


def changes(t: Tables) -> DataFrame:
    """Change rows of user accounts: sign-up creates, click and purchase update, error deletes."""
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    return (
        clicks(t)
        .where("event_type <> 'view'")
        .select(
            F.col("user_id").alias("id"),
            "event_id",
            "ts",
            op.alias("op"),
            F.col("event_type").alias("pay_status"),
            F.col("value").alias("total_amount"),
        )
    )


def user_grants(t: Tables) -> DataFrame:
    """One login per customer, with a comma list of the tables it may read; an empty list means all."""
    kind = F.col("c_nationkey") % 5
    granted = (
        F.when(kind == 0, F.lit(""))
        .when(kind == 1, F.lit("ads_realtime_overview, ads_shop_rank_daily"))
        .when(kind == 2, F.lit(" dws_shop_daily_gmv ,,dws_spu_daily_sales"))
        .when(kind == 3, F.lit("ads_top_spu_daily"))
        .otherwise(F.lit(None))
    )
    return t.customer.select(F.col("c_name").alias("username"), granted.alias("allowed_tables"), (kind == 1).alias("is_admin"))
