"""The views of ``bindings`` and the chains' tables as SQL for the oracle."""

from __future__ import annotations


def rounded(num: str, den: str, scale: int) -> str:
    """``num / den`` rounded half up in whole numbers; ``num`` is a whole number in units of 10^-scale."""
    return f"CASE WHEN ({den}) = 0 THEN NULL ELSE CAST((2 * ({num}) + ({den})) // (2 * ({den})) AS DOUBLE) / {10**scale} END"


def cents(expr: str) -> str:
    return f"CAST(({expr}) * 100 AS BIGINT)"


LINE_ID = (
    "concat_ws('-', CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), "
    "CAST(CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * 100 AS BIGINT) AS VARCHAR), "
    "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), strftime(l_shipdate, '%Y%m%d'))"
)
AMOUNT = "CAST(l_extendedprice AS DECIMAL(16,2))"
DISCOUNT = f"CAST({AMOUNT} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2))"

# name -> (views it reads, definition), in dependency order
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "heads": (
        (),
        """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderkey, CAST(o_orderkey % 10 AS VARCHAR) AS shop_id,
               s_name AS shop_name, CAST(o_custkey AS VARCHAR) AS buyer_uid, c_name AS buyer_nick,
               n_name AS receiver_province, CAST(o_totalprice AS DECIMAL(16,2)) AS total_pay_amount,
               CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderkey % 7 + 5 AS DECIMAL(16,2)) END AS freight_amount,
               CAST(o_orderkey % 13 AS DECIMAL(16,2)) AS total_discount_amount,
               CAST(CAST(o_totalprice AS DECIMAL(16,2)) + CAST(o_orderkey % 13 AS DECIMAL(16,2)) AS DECIMAL(16,2)) AS total_amount,
               CAST(coalesce(units, 0) AS INTEGER) AS total_quantity,
               CASE WHEN o_orderstatus IN ('F', 'O') THEN 'PAID' ELSE 'UNPAID' END AS pay_status,
               o_orderstatus AS order_status, o_orderdate AS create_time,
               strftime(o_orderdate, '%Y-%m-%d') AS order_date,
               o_orderdate + to_seconds(o_orderkey % 86400) AS proc_time
        FROM orders
        LEFT JOIN supplier ON s_suppkey = o_orderkey % 10
        LEFT JOIN customer ON c_custkey = o_custkey
        LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS units FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
        """,
    ),
    "versions": (
        ("heads",),
        """
        SELECT * REPLACE (CASE WHEN o_orderkey % 41 <> 0 THEN order_id END AS order_id,
                          CASE WHEN o_orderkey % 31 <> 0 THEN total_pay_amount END AS total_pay_amount)
        FROM (SELECT * FROM heads
              UNION ALL
              SELECT * REPLACE (proc_time + INTERVAL 1 HOUR AS proc_time, 'PAID' AS pay_status)
              FROM heads WHERE order_status = 'P')
        """,
    ),
    "lines": (
        ("heads",),
        f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, {LINE_ID} AS order_item_id, CAST(l_partkey AS VARCHAR) AS spu_id,
               CAST(l_quantity AS INTEGER) AS quantity, {AMOUNT} AS item_amount, {DISCOUNT} AS discount_amount,
               CAST({AMOUNT} - {DISCOUNT} AS DECIMAL(16,2)) AS item_pay_amount, shop_id, buyer_uid, pay_status, create_time,
               p_name AS spu_name, p_brand AS brand, p_type AS company_category_id,
               concat_ws('>', p_type, p_brand, p_name) AS company_category_path
        FROM lineitem JOIN heads ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey
        """,
    ),
    "parcels": (
        (),
        f"""
        SELECT concat_ws('/', CAST(l_orderkey AS VARCHAR), {LINE_ID}) AS order_id, CAST(l_suppkey AS VARCHAR) AS shop_id,
               CAST(l_orderkey AS VARCHAR) AS buyer_uid, {AMOUNT} AS total_pay_amount,
               CAST(l_quantity AS INTEGER) AS total_quantity,
               CASE WHEN l_linestatus = 'F' THEN 'PAID' ELSE 'UNPAID' END AS pay_status, l_shipdate AS create_time,
               {LINE_ID} AS line_id, CAST(l_partkey AS VARCHAR) AS part_id, l_returnflag,
               {DISCOUNT} AS discount, CAST({AMOUNT} - {DISCOUNT} AS DECIMAL(16,2)) AS pay
        FROM lineitem
        """,
    ),
    "parcel_lines": (
        ("parcels",),
        """
        SELECT order_id, shop_id, buyer_uid, pay_status, create_time, line_id AS order_item_id, part_id AS spu_id,
               total_quantity AS quantity, total_pay_amount AS item_amount, discount AS discount_amount,
               pay AS item_pay_amount, shop_id AS company_category_id
        FROM parcels WHERE total_quantity > 2
        UNION ALL
        SELECT order_id, shop_id, buyer_uid, pay_status, create_time, 'gift-' || line_id, shop_id, 1,
               CAST(0 AS DECIMAL(16,2)), CAST(0 AS DECIMAL(16,2)), CAST(0 AS DECIMAL(16,2)), 'gift'
        FROM parcels WHERE total_quantity > 2 AND l_returnflag = 'R'
        """,
    ),
    "shops": (
        ("heads",),
        f"""
        SELECT shop_id, max(shop_name) AS shop_name, order_date AS stat_date,
               count(DISTINCT order_id) AS order_cnt, count(DISTINCT buyer_uid) AS buyer_uv,
               sum(total_pay_amount) AS gmv, sum(total_discount_amount) AS discount_amt, sum(freight_amount) AS freight_amt,
               sum(total_pay_amount - freight_amount) AS net_pay_amt,
               {rounded(cents("sum(total_pay_amount)"), "count(DISTINCT order_id)", 2)} AS avg_order_amount,
               CAST(sum(total_quantity) AS BIGINT) AS total_quantity
        FROM heads WHERE pay_status = 'PAID' GROUP BY shop_id, order_date
        """,
    ),
    "spus": (
        ("lines",),
        """
        SELECT spu_id, max(spu_name) AS spu_name, max(brand) AS brand, strftime(create_time, '%Y-%m-%d') AS stat_date,
               count(DISTINCT order_id) AS order_cnt, count(DISTINCT order_item_id) AS sku_sold_cnt,
               CAST(sum(quantity) AS BIGINT) AS quantity, sum(item_pay_amount) AS gmv,
               sum(discount_amount) AS discount_amt, count(DISTINCT buyer_uid) AS buyer_uv
        FROM lines WHERE pay_status = 'PAID' GROUP BY spu_id, strftime(create_time, '%Y-%m-%d')
        """,
    ),
    "categories": (
        ("lines",),
        """
        SELECT company_category_id, max(company_category_path) AS company_category_path,
               strftime(create_time, '%Y-%m-%d') AS stat_date, count(DISTINCT order_id) AS order_cnt,
               CAST(sum(quantity) AS BIGINT) AS quantity, sum(item_pay_amount) AS gmv,
               sum(discount_amount) AS discount_amt, count(DISTINCT buyer_uid) AS buyer_uv
        FROM lines WHERE pay_status = 'PAID' GROUP BY company_category_id, strftime(create_time, '%Y-%m-%d')
        """,
    ),
    "buyers": (
        ("heads",),
        f"""
        SELECT order_date AS stat_date, count(DISTINCT buyer_uid) AS buyer_uv, count(DISTINCT buyer_uid) AS new_buyer_uv,
               count(DISTINCT order_id) AS order_cnt, sum(total_pay_amount) AS gmv,
               {rounded("100 * count(DISTINCT order_id)", "count(DISTINCT buyer_uid)", 2)} AS avg_orders_per_user,
               {rounded(cents("sum(total_pay_amount)"), "count(DISTINCT buyer_uid)", 2)} AS avg_gmv_per_user
        FROM heads WHERE pay_status = 'PAID' GROUP BY order_date
        """,
    ),
    "overview": (
        ("shops",),
        f"""
        SELECT stat_date, sum(gmv) AS gmv, CAST(sum(order_cnt) AS BIGINT) AS order_cnt, CAST(sum(buyer_uv) AS BIGINT) AS buyer_uv,
               CAST(sum(order_cnt) AS BIGINT) AS paid_order_cnt, sum(gmv) AS paid_gmv,
               CAST(sum(buyer_uv) AS BIGINT) AS paid_buyer_uv, sum(discount_amt) AS discount_amt,
               sum(freight_amt) AS freight_amt,
               {rounded(cents("sum(gmv)"), "CAST(sum(order_cnt) AS BIGINT)", 2)} AS avg_order_amount
        FROM shops GROUP BY stat_date
        """,
    ),
    "shop_rank": (
        ("shops",),
        """
        SELECT stat_date, CAST(row_number() OVER (PARTITION BY stat_date ORDER BY gmv DESC, shop_id) AS INTEGER) AS rank_no,
               shop_id, shop_name, gmv, order_cnt, buyer_uv, avg_order_amount
        FROM shops
        """,
    ),
    "spu_rank": (
        ("spus",),
        """
        SELECT stat_date, CAST(row_number() OVER (PARTITION BY stat_date ORDER BY gmv DESC, spu_id) AS INTEGER) AS rank_no,
               spu_id, spu_name, brand, quantity, gmv, order_cnt, buyer_uv
        FROM spus
        """,
    ),
    "r_orders": (
        (),
        """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
               CASE WHEN o_orderkey % 97 = 0 THEN 'x' ELSE '' END || CAST(o_orderkey % 200 AS VARCHAR) AS product_id,
               CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN CAST(0 AS DECIMAL(16,2))
                    ELSE CAST(o_totalprice AS DECIMAL(16,2)) END AS order_amount,
               CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'refunded' ELSE 'created' END AS order_status,
               n_name AS province, o_orderpriority AS channel, o_orderdate AS create_time,
               strftime(o_orderdate, '%Y%m%d') AS dt
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
        """,
    ),
    "r_products": (
        (),
        """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category_name
        FROM part WHERE p_size <= 45
        """,
    ),
    "r_users": (
        (),
        """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS user_name, c_mktsegment AS register_channel,
               strftime(DATE '2024-01-01' + CAST(c_custkey % 28 AS INTEGER), '%Y%m%d') AS register_date
        FROM customer
        """,
    ),
    "r_dwd": (
        ("r_orders",),
        """
        SELECT order_id, user_id, product_id, order_amount, order_status,
               CASE WHEN order_status = 'refunded' THEN 1 ELSE 0 END AS is_refunded, province, channel, create_time, dt
        FROM r_orders WHERE order_amount IS NOT NULL AND order_amount > 0
        """,
    ),
    "r_channel": (
        ("r_dwd",),
        """
        SELECT dt, channel, count(DISTINCT user_id) AS uv, count(*) AS order_cnt,
               CAST(sum(CASE WHEN order_status = 'paid' THEN 1 ELSE 0 END) AS BIGINT) AS paid_order_cnt,
               sum(CASE WHEN order_status = 'paid' THEN order_amount ELSE 0 END) AS gmv,
               CAST(sum(CASE WHEN order_status = 'refunded' THEN 1 ELSE 0 END) AS BIGINT) AS refund_cnt
        FROM r_dwd GROUP BY dt, channel
        """,
    ),
    "r_province": (
        ("r_dwd",),
        """
        SELECT dt, province, count(*) AS order_cnt,
               CAST(sum(CASE WHEN order_status = 'paid' THEN 1 ELSE 0 END) AS BIGINT) AS paid_order_cnt,
               count(DISTINCT CASE WHEN order_status = 'paid' THEN user_id END) AS paid_user_cnt,
               sum(CASE WHEN order_status = 'paid' THEN order_amount ELSE 0 END) AS gmv
        FROM r_dwd GROUP BY dt, province
        """,
    ),
    "r_product": (
        ("r_dwd", "r_products"),
        """
        SELECT o.dt, o.product_id, p.product_name, p.category_name, count(*) AS sale_cnt, sum(o.order_amount) AS sale_amount
        FROM r_dwd o LEFT JOIN r_products p ON o.product_id = p.product_id
        GROUP BY o.dt, o.product_id, p.product_name, p.category_name
        """,
    ),
    "r_growth": (
        ("r_users",),
        """
        SELECT register_date AS dt, register_channel, count(*) AS new_user_cnt
        FROM r_users GROUP BY register_date, register_channel
        """,
    ),
    "r_overview": (
        ("r_dwd",),
        """
        SELECT dt, count(*) AS total_order_cnt,
               CAST(sum(CASE WHEN order_status = 'paid' THEN 1 ELSE 0 END) AS BIGINT) AS paid_order_cnt,
               sum(CASE WHEN order_status = 'paid' THEN order_amount ELSE 0 END) AS total_gmv,
               count(DISTINCT CASE WHEN order_status = 'paid' THEN user_id END) AS paid_user_cnt
        FROM r_dwd GROUP BY dt
        """,
    ),
    "changes": (
        (),
        """
        SELECT user_id AS id, event_id, ts,
               CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
               event_type AS pay_status, CAST(value AS DECIMAL(16,2)) AS total_amount
        FROM events WHERE event_type <> 'view'
        """,
    ),
    "grants": (
        (),
        """
        SELECT c_name AS username,
               CASE c_nationkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'ads_realtime_overview, ads_shop_rank_daily'
                    WHEN 2 THEN ' dws_shop_daily_gmv ,,dws_spu_daily_sales' WHEN 3 THEN 'ads_top_spu_daily' END AS allowed_tables,
               c_nationkey % 5 = 1 AS is_admin
        FROM customer
        """,
    ),
}


def with_views(names: tuple[str, ...], body: str) -> str:
    """``body`` behind a WITH list of the named views and whatever they read."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in VIEWS[name][0]:
                add(other)

    for name in names:
        add(name)
    parts = [f"{name} AS ({definition.strip()})" for name, (_, definition) in VIEWS.items() if name in wanted]
    lead = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return lead + body.strip()


def doubles(view: str, *columns: str, tail: str = "") -> str:
    """Every column of a view, the named decimals as doubles."""
    if not columns:
        return f"SELECT * FROM {view} {tail}"
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM {view} {tail}"


def clock(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"
