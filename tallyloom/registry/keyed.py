"""Checked queries of keyed writes, permissions, statement checks and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom import bindings as b
from tallyloom.contracts import MARKETPLACE, SERVED
from tallyloom.functions import scalars as s
from tallyloom.operators import access, guard, keyed
from tallyloom.registry.base import query
from tallyloom.registry.marketplace import shops
from tallyloom.registry.sql import VIEWS, doubles
from tallyloom.session import work_path
from tallyloom.sinks.tables import read_table, replace_table
from tallyloom.sources.tables import register_views

ORDER = ("order_id", "pay_status", "total_pay_amount", "proc_time")


@query(
    "upsert_last_wins",
    ("heads",),
    """SELECT order_id, pay_status, CAST(total_pay_amount AS DOUBLE) AS total_pay_amount,
              strftime(seen, '%Y-%m-%d %H:%M:%S') AS proc_time
        FROM (SELECT order_id, 'PAID' AS pay_status, total_pay_amount * 2 AS total_pay_amount, proc_time + INTERVAL 1 HOUR AS seen
              FROM heads WHERE order_status = 'P'
              UNION ALL
              SELECT order_id, pay_status, total_pay_amount, proc_time FROM heads WHERE order_status <> 'P')""",
)
def upserted(t):
    """Open orders come twice more; the last of the two replaces what the table holds."""
    held = b.order_heads(t).select("order_status", *ORDER)
    doubled = (F.col("total_pay_amount") * 2).cast(b.MONEY)
    later = held.where("order_status = 'P'").withColumns(
        {"pay_status": F.lit("PAID"), "total_pay_amount": doubled, "proc_time": F.col("proc_time") + F.expr("INTERVAL 1 HOUR")}
    )
    soon = later.withColumns({"pay_status": F.lit("CHECKING"), "proc_time": F.col("proc_time") - F.expr("INTERVAL 30 MINUTES")})
    return keyed.upsert(held, soon.unionByName(later), ["order_id"], ["proc_time"]).select(*ORDER)


@query(
    "insert_if_absent",
    (),
    """SELECT c_custkey AS user_id, 'held' AS origin FROM customer WHERE c_mktsegment = 'BUILDING'
       UNION ALL SELECT c_custkey, 'new' FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def inserted(t):
    users = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    held = users.where("c_mktsegment = 'BUILDING'").select("user_id", F.lit("held").alias("origin"))
    return keyed.insert_if_absent(held, users.select("user_id", F.lit("new").alias("origin")), ["user_id"])


@query(
    "add_missing_column",
    ("grants",),
    """SELECT username, CASE WHEN is_admin THEN 1 ELSE 0 END AS is_admin FROM grants WHERE allowed_tables IS NOT NULL
       UNION ALL SELECT username, 0 FROM grants WHERE allowed_tables IS NULL""",
)
def evolved(t):
    """Users written before the admin flag existed meet users written with it."""
    users = b.user_grants(t)
    old = users.where("allowed_tables IS NULL").select("username")
    new = users.where("allowed_tables IS NOT NULL").select("username", F.col("is_admin").cast("int").alias("is_admin"))
    return keyed.union_evolved(old, new, "is_admin", F.lit(0))


@query(
    "update_delete_by_key",
    ("grants",),
    """SELECT username, CASE WHEN is_admin THEN NULL ELSE allowed_tables END AS allowed_tables FROM grants
       WHERE allowed_tables IS NULL OR allowed_tables <> ''""",
)
def edited(t):
    """Grants of admins are cleared, users with an empty list are removed."""
    users = b.user_grants(t)
    cleared = users.where("is_admin").select("username", F.lit(None).cast("string").alias("allowed_tables"))
    kept = keyed.delete_by_key(users, users.where("allowed_tables = ''"), ["username"])
    return keyed.update_by_key(kept, cleared, ["username"], ["allowed_tables"]).select("username", "allowed_tables")


@query(
    "write_readback",
    ("shops",),
    doubles("shops", "gmv", "discount_amt", "freight_amt", "net_pay_amt", tail="ORDER BY shop_id, stat_date"),
)
def readback(t):
    table = MARKETPLACE["dws_shop_daily_gmv"]
    path = work_path(t.spark, table.name)
    replace_table(shops(t), path, table)
    return read_table(t.spark, path, table.schema).orderBy("shop_id", "stat_date")


@query(
    "union_all_rows",
    ("heads",),
    """SELECT 'order' AS kind, order_id AS id FROM heads UNION ALL SELECT 'order', order_id FROM heads WHERE pay_status = 'UNPAID'
       UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR) FROM customer""",
)
def unioned(t):
    """Rows of several inputs one after another, equal rows kept."""
    heads = b.order_heads(t)
    orders = heads.select(F.lit("order").alias("kind"), F.col("order_id").alias("id"))
    again = heads.where("pay_status = 'UNPAID'").select(F.lit("order").alias("kind"), F.col("order_id").alias("id"))
    customers = t.customer.select(F.lit("customer").alias("kind"), b.text("c_custkey").alias("id"))
    return orders.unionAll(again).unionByName(customers)


def requests(t):
    """Every user asks for each of the served tables."""
    return b.user_grants(t).select("username", F.explode(F.array(*[F.lit(n) for n in SERVED])).alias("table_name"))


SERVED_LIST = ", ".join(f"('{name}')" for name in SERVED)
CHECKED = f"""
checked AS (SELECT username, table_name,
                   trim(coalesce(allowed_tables, '')) = ''
                   OR list_contains(regexp_split_to_array(trim(allowed_tables), '[ ,]+'), table_name) AS ok
            FROM grants, (VALUES {SERVED_LIST}) v(table_name))"""


def _checked(tail: str) -> str:
    return f"WITH grants AS ({VIEWS['grants'][1].strip()}), {CHECKED.strip()} {tail}"


@query("authorized_tables", (), _checked("SELECT username, table_name FROM checked WHERE ok"))
def authorized(t):
    return access.authorized_tables(requests(t), b.user_grants(t))


@query("unauthorized_tables", (), _checked("SELECT username, table_name FROM checked WHERE NOT ok"))
def unauthorized(t):
    return access.unauthorized_tables(requests(t), b.user_grants(t))


UNKNOWN = "SELECT 'new ' || c_name AS username, 'ads_top_spu_daily' AS table_name FROM customer WHERE c_nationkey = 3"


@query(
    "request_audit",
    (),
    _checked(
        f"""SELECT username, table_name, ok AS authorized, CASE WHEN NOT ok THEN 'not granted' END AS reason FROM checked
            UNION ALL SELECT username, table_name, false, 'unknown user' FROM ({UNKNOWN})"""
    ),
)
def audited_requests(t):
    """Allowed and refused requests together, some of users that are not known."""
    name = F.concat(F.lit("new "), "c_name").alias("username")
    unknown = t.customer.where("c_nationkey = 3").select(name, F.lit("ads_top_spu_daily").alias("table_name"))
    return access.request_audit(requests(t).unionByName(unknown), b.user_grants(t))


@query("allowed_users", (), _checked("SELECT username, bool_and(ok) AS allowed FROM checked GROUP BY username"))
def allowed(t):
    return access.allowed_users(requests(t), b.user_grants(t))


@query(
    "user_grants",
    ("grants",),
    """SELECT username, trim(item) AS table_name FROM (SELECT username, unnest(string_split(allowed_tables, ',')) AS item FROM grants)
       WHERE trim(item) <> ''""",
)
def grants(t):
    return access.user_grants(b.user_grants(t))


STATEMENTS = (
    "SELECT stat_date, gmv FROM ads_realtime_overview",
    "  select 1; drop table users",
    "DELETE FROM dws_shop_daily_gmv",
    "with a as (select 1) select * from a",
    "   ",
    "SHOW TABLES",
    "SELECTX",
    "explain select 1",
    "UPDATE users SET is_admin = 1",
    "Desc dws_shop_daily_gmv",
)


def statement_log(t):
    """A log of statements, one per order, each carrying its order in a comment."""
    number = (F.col("o_orderkey") % len(STATEMENTS)).cast("int")
    text = F.get(F.array(*[F.lit(x) for x in STATEMENTS]), number)
    tagged = F.when(F.trim(text) != "", F.concat(text, F.lit(" -- "), b.text("o_orderkey"))).otherwise(text)
    return t.orders.select(F.col("o_orderkey").alias("log_id"), tagged.alias("statement"))


@query(
    "audit_statements",
    (),
    f"""SELECT log_id, statement, reason, reason IS NULL AS allowed FROM (
          SELECT log_id, statement,
                 CASE WHEN trim(statement) = '' THEN 'empty statement'
                      WHEN NOT (starts_with(upper(trim(statement)), 'SELECT') OR starts_with(upper(trim(statement)), 'SHOW')
                                OR starts_with(upper(trim(statement)), 'DESC') OR starts_with(upper(trim(statement)), 'EXPLAIN')
                                OR starts_with(upper(trim(statement)), 'WITH')) THEN 'not a read-only statement'
                      WHEN contains(statement, ';') THEN 'more than one statement' END AS reason
          FROM (SELECT log_id, CASE WHEN trim(text) <> '' THEN text || ' -- ' || CAST(log_id AS VARCHAR) ELSE text END AS statement
                FROM (SELECT o_orderkey AS log_id, list_extract([{", ".join("'" + x + "'" for x in STATEMENTS)}],
                             CAST(o_orderkey % {len(STATEMENTS)} AS INTEGER) + 1) AS text FROM orders)))""",
)
def audited(t):
    return guard.audit_statements(statement_log(t))


@query(
    "readonly_sql",
    ("shops",),
    """SELECT stat_date, CAST(sum(gmv) AS DOUBLE) AS gmv FROM shops GROUP BY stat_date
       ORDER BY sum(gmv) DESC, stat_date LIMIT 100""",
)
def readonly(t):
    """An analyst's statement over a registered table."""
    register_views({"warehouse.mall.dws_shop_daily_gmv": shops(t)})
    return guard.readonly_sql(
        t.spark,
        "SELECT stat_date, SUM(gmv) AS gmv FROM dws_shop_daily_gmv GROUP BY stat_date ORDER BY gmv DESC, stat_date LIMIT 100;",
    )


@query(
    "scalar_functions",
    ("heads",),
    """SELECT order_id,
              CASE WHEN pay_status = 'PAID' THEN 1 ELSE 0 END AS f_case,
              CAST(order_id AS BIGINT) AS f_cast,
              CAST(CAST(order_id AS BIGINT) * 7 AS INTEGER) AS f_int,
              nullif(shop_id, '0') AS f_nullif,
              freight_amount IS NULL AS f_is_null,
              strftime(create_time, '%Y-%m-%d') AS f_day,
              strftime(CAST(create_time AS DATE) - 6, '%Y-%m-%d') AS f_day_before,
              replace(order_date, '-', '') AS f_replace,
              lpad(order_id, 10, '0') AS f_lpad,
              'DY' || order_id AS f_concat,
              CAST(floor(CAST(total_pay_amount AS DOUBLE) / 1000) AS BIGINT) AS f_floor,
              CAST(order_id AS BIGINT) % 9 AS f_mod,
              CAST(total_pay_amount + coalesce(freight_amount, 0) - total_discount_amount AS DOUBLE) AS f_arithmetic,
              CAST(round(total_pay_amount, 1) AS DOUBLE) AS f_round,
              trim(split_part('a, b ,c' || order_id, ',', 2)) AS f_split_trim,
              CASE WHEN receiver_province IS NULL THEN NULL ELSE split_part(receiver_province || '>' || shop_id || '> x', '>', 3) END AS f_raw_level,
              CASE WHEN receiver_province IS NULL THEN NULL ELSE trim(split_part(receiver_province || '>' || shop_id || '> x', '>', 3)) END AS f_level,
              CAST(NULL AS VARCHAR) AS f_no_level,
              format('{:,.2f}', CAST(total_pay_amount AS DOUBLE)) AS f_money,
              sha256(order_id) AS f_sha256,
              'SELECT ' || order_id AS f_after
       FROM heads""",
)
def scalar_functions(t):
    path = F.concat("receiver_province", F.lit(">"), "shop_id", F.lit("> x"))
    number = F.col("order_id").cast("bigint")
    freight = F.coalesce(F.col("freight_amount"), F.lit(0))
    return b.order_heads(t, "region").select(
        "order_id",
        F.when(F.col("pay_status") == "PAID", 1).otherwise(0).alias("f_case"),
        number.alias("f_cast"),
        (number * 7).try_cast("int").alias("f_int"),
        F.nullif("shop_id", F.lit("0")).alias("f_nullif"),
        F.col("freight_amount").isNull().alias("f_is_null"),
        s.day_text("create_time").alias("f_day"),
        F.date_format(F.date_sub(F.to_date("create_time"), 6), s.DAY).alias("f_day_before"),
        s.compact_day("order_date").alias("f_replace"),
        F.lpad("order_id", 10, "0").alias("f_lpad"),
        F.concat(F.lit("DY"), "order_id").alias("f_concat"),
        F.floor(F.col("total_pay_amount").cast("double") / 1000).alias("f_floor"),
        (number % 9).alias("f_mod"),
        (F.col("total_pay_amount") + freight - F.col("total_discount_amount")).alias("f_arithmetic"),
        F.round("total_pay_amount", 1).alias("f_round"),
        F.get(s.list_items(F.concat(F.lit("a, b ,c"), "order_id")), F.lit(1)).alias("f_split_trim"),
        F.get(F.split(path, ">"), F.lit(2)).alias("f_raw_level"),
        s.category_level(path, 3).alias("f_level"),
        s.category_level(path, 4).alias("f_no_level"),
        s.money_text("total_pay_amount").alias("f_money"),
        F.sha2("order_id", 256).alias("f_sha256"),
        s.after_last(F.concat(F.lit("thinking</think> SELECT "), "order_id"), "</think>").alias("f_after"),
    )
