"""Checked queries of the analyst layer: filters, sorts, limits, metrics, terms and retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom import bindings as b
from tallyloom.functions import scalars as s
from tallyloom.operators import filters, retrieval
from tallyloom.operators.ranking import first_within, top
from tallyloom.plans import marketplace as m
from tallyloom.plans import metrics, retail, terms
from tallyloom.registry.base import query
from tallyloom.registry.marketplace import buyers, categories, overview, shops, spus
from tallyloom.registry.retail import orders
from tallyloom.registry.sql import cents, rounded
from tallyloom.session import stored

LAST_DAY = "2001-08-01"
PERIOD_DAY = "1998-05-14"


def recent_overview(t, days, as_of=LAST_DAY):
    """The overview of the last days, reading only those days' orders."""
    heads = filters.since_days(b.order_heads(t, "shop", "quantity"), days, as_of, "create_time")
    return m.ads_realtime_overview(m.dws_shop_daily_gmv(heads, b.PAID))


@query(
    "filter_recent_days",
    ("overview",),
    """SELECT stat_date, CAST(gmv AS DOUBLE) AS gmv, order_cnt FROM overview
       WHERE stat_date >= strftime(CAST((SELECT max(stat_date) FROM overview) AS DATE) - 29, '%Y-%m-%d')""",
)
def recent_days(t):
    return filters.filter_recent_days(stored(overview(t), "overview"), 30).select("stat_date", "gmv", "order_cnt")


@query(
    "filter_dt_range",
    ("r_overview",),
    """SELECT dt, CAST(total_gmv AS DOUBLE) AS total_gmv, paid_user_cnt FROM r_overview
       WHERE dt BETWEEN replace('1996-03-01', '-', '') AND replace('1997-02-28', '-', '')""",
)
def dt_range(t):
    rows = filters.filter_dt_range(retail.ads_trade_overview_di(orders(t)), "1996-03-01", "1997-02-28")
    return rows.select("dt", "total_gmv", "paid_user_cnt").orderBy("dt")


@query(
    "filter_single_day",
    ("shops",),
    "SELECT stat_date, shop_id, CAST(gmv AS DOUBLE) AS gmv, order_cnt FROM shops WHERE stat_date = '1998-10-03'",
)
def single_day(t):
    return filters.filter_single_day(shops(t), "1998-10-03").select("stat_date", "shop_id", "gmv", "order_cnt")


@query(
    "metric_by_period",
    ("overview",),
    f"""SELECT name AS period, CAST(sum(gmv) AS DOUBLE) AS gmv, CAST(sum(order_cnt) AS BIGINT) AS order_cnt, min(stat_date) AS first_day, max(stat_date) AS last_day
        FROM overview JOIN (VALUES
          ('今天', DATE '{PERIOD_DAY}', DATE '{PERIOD_DAY}'), ('昨天', DATE '{PERIOD_DAY}' - 1, DATE '{PERIOD_DAY}' - 1),
          ('本周', CAST(date_trunc('week', DATE '{PERIOD_DAY}') AS DATE), DATE '{PERIOD_DAY}'),
          ('上周', CAST(date_trunc('week', DATE '{PERIOD_DAY}') AS DATE) - 7, CAST(date_trunc('week', DATE '{PERIOD_DAY}') AS DATE) - 1),
          ('本月', CAST(date_trunc('month', DATE '{PERIOD_DAY}') AS DATE), DATE '{PERIOD_DAY}'),
          ('上月', CAST(date_trunc('month', DATE '{PERIOD_DAY}') - INTERVAL 1 MONTH AS DATE), CAST(date_trunc('month', DATE '{PERIOD_DAY}') AS DATE) - 1)
        ) v(name, a, z) ON CAST(stat_date AS DATE) BETWEEN a AND z GROUP BY name""",
)
def by_period(t):
    """Sales of the named periods, all read in one pass."""
    days = filters.since_days(b.order_heads(t, "shop", "quantity"), 62, PERIOD_DAY, "create_time")
    daily = m.ads_realtime_overview(m.dws_shop_daily_gmv(days, b.PAID))
    names = []
    for name in filters.PERIODS:
        first, last = filters.period_range(name, PERIOD_DAY)
        names.append(F.when(F.col("stat_date").cast("date").between(first, last), F.lit(name)))
    rows = daily.withColumn("period", F.explode(F.array_compact(F.array(*names))))
    sums = [F.sum("gmv").alias("gmv"), F.sum("order_cnt").alias("order_cnt")]
    return rows.groupBy("period").agg(*sums, F.min("stat_date").alias("first_day"), F.max("stat_date").alias("last_day"))


@query("trend_sorted", ("overview",), "SELECT stat_date, CAST(gmv AS DOUBLE) AS gmv FROM overview ORDER BY stat_date")
def trend_sorted(t):
    return overview(t).select("stat_date", "gmv").orderBy("stat_date")


@query(
    "metric_trend",
    ("overview",),
    f"""SELECT stat_date, CAST(gmv AS DOUBLE) AS gmv FROM overview
        WHERE stat_date >= strftime(DATE '{LAST_DAY}' - 6, '%Y-%m-%d') ORDER BY stat_date""",
)
def metric_trend(t):
    return metrics.metric_trend(recent_overview(t, metrics.DEFAULT_DAYS), "gmv", as_of=LAST_DAY)


@query(
    "shop_trend",
    ("shops",),
    f"""SELECT stat_date, shop_id, CAST(gmv AS DOUBLE) AS gmv, order_cnt FROM shops
        WHERE shop_id = '3' AND stat_date >= strftime(DATE '{LAST_DAY}' - 29, '%Y-%m-%d') ORDER BY stat_date""",
)
def shop_trend(t):
    heads = filters.since_days(b.order_heads(t, "shop", "quantity"), 30, LAST_DAY, "create_time")
    return metrics.shop_trend(m.dws_shop_daily_gmv(heads, b.PAID), "3", ["gmv", "order_cnt"], 30, LAST_DAY)


@query(
    "metric_total_period",
    ("shops",),
    """SELECT shop_id, CAST(sum(gmv) AS DOUBLE) AS gmv, CAST(sum(order_cnt) AS BIGINT) AS order_cnt,
              CAST(sum(total_quantity) AS BIGINT) AS total_quantity
       FROM shops GROUP BY shop_id""",
)
def period_total(t):
    return metrics.metric_total_period(shops(t), ["shop_id"], ["gmv", "order_cnt", "total_quantity"])


@query(
    "avg_order_amount",
    ("shops",),
    f"""SELECT shop_id, CAST(sum(gmv) AS DOUBLE) AS gmv, CAST(sum(order_cnt) AS BIGINT) AS order_cnt,
               {rounded(cents("sum(gmv)"), "CAST(sum(order_cnt) AS BIGINT)", 2)} AS avg_order_amount
        FROM shops GROUP BY shop_id""",
)
def order_amount(t):
    return metrics.avg_order_amount(shops(t), ["shop_id"])


@query(
    "net_pay_compare",
    ("shops",),
    "SELECT shop_id, shop_name, CAST(sum(net_pay_amt) AS DOUBLE) AS net_pay_amt FROM shops GROUP BY shop_id, shop_name",
)
def net_pay(t):
    return metrics.net_pay_compare(shops(t))


@query(
    "brand_sales",
    ("spus",),
    """SELECT brand, CAST(sum(gmv) AS DOUBLE) AS gmv, CAST(sum(quantity) AS BIGINT) AS quantity,
              CAST(sum(order_cnt) AS BIGINT) AS order_cnt
       FROM spus GROUP BY brand""",
)
def brand_sales(t):
    return metrics.brand_sales(spus(t))


@query(
    "category_level1_rank",
    ("categories",),
    """SELECT trim(split_part(company_category_path, '>', 1)) AS category_level1, CAST(sum(gmv) AS DOUBLE) AS gmv
       FROM categories GROUP BY 1 ORDER BY gmv DESC, category_level1 LIMIT 100""",
)
def category_rank(t):
    return metrics.category_level1_rank(categories(t))


@query(
    "new_buyer_share",
    ("buyers",),
    f"""SELECT stat_date, new_buyer_uv, buyer_uv, {rounded("10000 * new_buyer_uv", "buyer_uv", 4)} AS new_buyer_share
        FROM buyers""",
)
def buyer_share(t):
    return metrics.new_buyer_share(buyers(t))


def _ranked(phrase, value, order):
    return f"""(SELECT '{phrase}' AS meaning, spu_id, {value} AS metric_value
                FROM spus GROUP BY spu_id ORDER BY {order} DESC, spu_id LIMIT 10)"""


@query(
    "rank_by_metric",
    ("spus",),
    " UNION ALL ".join(
        (
            _ranked("卖得最好", "CAST(sum(gmv) AS DOUBLE)", "sum(gmv)"),
            _ranked("销量最高", "CAST(sum(quantity) AS DOUBLE)", "sum(quantity)"),
            _ranked("人气最高", "CAST(sum(buyer_uv) AS DOUBLE)", "sum(buyer_uv)"),
            _ranked("客单价最高", rounded(cents("sum(gmv)"), "CAST(sum(order_cnt) AS BIGINT)", 2), "metric_value"),
        )
    ),
)
def sort_meanings(t):
    """The top ten products for each way of asking for the best."""
    daily = stored(spus(t), "spus")
    rows = None
    for phrase in ("卖得最好", "销量最高", "人气最高", "客单价最高"):
        best = metrics.rank_by_metric(daily, ["spu_id"], phrase).select(
            F.lit(phrase).alias("meaning"), "spu_id", F.col("metric_value").cast("double").alias("metric_value")
        )
        rows = best if rows is None else rows.unionByName(best)
    return rows


@query(
    "top_shops_day",
    ("shop_rank",),
    """SELECT rank_no, shop_id, shop_name, CAST(gmv AS DOUBLE) AS gmv FROM shop_rank
       WHERE stat_date = '1998-10-03' ORDER BY rank_no LIMIT 10""",
)
def top_shops(t):
    ranking = first_within(shops(t), "stat_date", "gmv", "shop_id", metrics.DEFAULT_TOP)
    return metrics.top_shops_day(ranking, "1998-10-03")


@query(
    "top_spu_period",
    ("spus",),
    """SELECT spu_id, max(spu_name) AS spu_name, max(brand) AS brand, CAST(sum(gmv) AS DOUBLE) AS gmv,
              CAST(sum(quantity) AS BIGINT) AS quantity
       FROM spus GROUP BY spu_id ORDER BY sum(gmv) DESC, spu_id LIMIT 10""",
)
def top_spus(t):
    """No count is read here, so the distinct ones fall out of the plan and leave sums that the map tasks reduce."""
    return metrics.top_spu_period(spus(t, keyed=False))


@query(
    "row_cap",
    ("heads",),
    """SELECT order_id, CAST(total_pay_amount AS DOUBLE) AS total_pay_amount FROM heads
       ORDER BY total_pay_amount DESC, order_id LIMIT 200""",
)
def capped(t):
    """A detail query that asks for a thousand rows gets the cap of two hundred."""
    rows = b.order_heads(t).select("order_id", "total_pay_amount")
    return metrics.row_cap(rows, [F.desc("total_pay_amount"), F.asc("order_id")], 1000, detail=True)


@query(
    "preview",
    ("parcel_lines",),
    """SELECT order_id, order_item_id, quantity, CAST(item_pay_amount AS DOUBLE) AS item_pay_amount FROM parcel_lines
       ORDER BY order_id, order_item_id LIMIT 5""",
)
def preview(t):
    rows = m.order_detail(b.parcel_messages(t)).select("order_id", "order_item_id", "quantity", "item_pay_amount")
    return top(rows, 5, F.asc("order_id"), F.asc("order_item_id"))


@query(
    "sort_desc",
    ("shops",),
    "SELECT stat_date, shop_id, CAST(gmv AS DOUBLE) AS gmv FROM shops ORDER BY gmv DESC, stat_date DESC, shop_id",
)
def sort_desc(t):
    return shops(t).select("stat_date", "shop_id", "gmv").orderBy(F.desc("gmv"), F.desc("stat_date"), "shop_id")


@query(
    "answer_table",
    ("shops",),
    """SELECT shop_id, format('{:,.2f}', CAST(sum(gmv) AS DOUBLE)) AS gmv, format('{:,}', CAST(sum(order_cnt) AS BIGINT)) AS order_cnt
       FROM shops GROUP BY shop_id ORDER BY sum(gmv) DESC, shop_id LIMIT 10""",
)
def answer(t):
    totals = metrics.metric_total_period(shops(t), ["shop_id"], ["gmv", "order_cnt"])
    return metrics.answer_table(totals, ["gmv"], ["order_cnt"], [F.desc("gmv"), F.asc("shop_id")])


# Wordings of the question log: every user turn of the test conversations ends in one of them.
WORDINGS = (
    "最近七天各店铺的销售额",
    "哪个品牌的销量最高",
    "昨天支付订单有多少，客单价呢",
    "这个类目的商品优惠和运费",
    "SPU 排名前十的宝贝",
    "买家的人均单数和人均金额",
    "各门店订单数与折扣",
    "how are GMV and UV today",
    "上月卖了多少钱，平均每单多少钱",
    "本周多少人买，到手金额呢",
    "昨天的出货量和客群规模",
)


@query(
    "normalize_terms",
    (),
    f"""WITH terms(term, column_name) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in terms.TERMS.items())}),
             log AS (SELECT conv_id, turn, text || ' ' || list_extract([{", ".join(f"'{w}'" for w in WORDINGS)}],
                            CAST((conv_id + turn) % {len(WORDINGS)} AS INTEGER) + 1) AS question
                     FROM conversations WHERE role = 'user'),
             hits AS (SELECT DISTINCT conv_id, turn, unnest(regexp_extract_all(question, '{terms.term_pattern(terms.TERMS)}')) AS term
                      FROM log)
        SELECT conv_id, turn, hits.term, column_name FROM hits JOIN terms ON terms.term = hits.term""",
)
def normalized(t):
    wording = F.get(F.array(*[F.lit(w) for w in WORDINGS]), ((F.col("conv_id") + F.col("turn")) % len(WORDINGS)).cast("int"))
    log = t.conversations.where("role = 'user'").select(
        "conv_id", "turn", F.concat("text", F.lit(" "), wording).alias("question")
    )
    return terms.normalize_terms(log)


HITS = """
WITH q AS (SELECT item_id AS question_id, list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS qw, CAST(embedding AS DOUBLE[]) AS qv
           FROM benchmark LEFT JOIN embeddings ON vec_id = item_id),
     c AS (SELECT doc_id AS chunk_id, list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS cw, CAST(embedding AS DOUBLE[]) AS cv
           FROM documents LEFT JOIN embeddings ON vec_id = doc_id),
     parts AS (SELECT question_id, chunk_id, round(coalesce(list_cosine_similarity(cv, qv), 0), 6) AS vector_score,
                      round(len(list_intersect(cw, qw)) / greatest(len(qw), 1), 6) AS keyword_score FROM q, c),
     scored AS (SELECT *, round(vector_score * 0.7 + keyword_score * 0.3, 6) AS score FROM parts),
     hits AS (SELECT * FROM (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_id) <= 5) WHERE score >= 0.3)
"""


def chunks(t):
    return t.documents.select(F.col("doc_id").alias("chunk_id"), "text")


def hits(t):
    """The best chunks for every item of the benchmark as a question."""
    questions = t.benchmark.select(F.col("item_id").alias("question_id"), "text").join(
        t.embeddings.select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("vector")), "question_id", "left"
    )
    vectors = t.embeddings.select(F.col("vec_id").alias("chunk_id"), F.col("embedding").alias("vector"))
    return retrieval.hybrid_topk(chunks(t), vectors, questions)


@query("hybrid_topk", (), HITS + "SELECT question_id, chunk_id, vector_score, keyword_score, score FROM hits")
def hybrid(t):
    return hits(t)


@query(
    "concat_context",
    (),
    HITS
    + """SELECT question_id, string_agg(text || chr(13) || chr(10) || chr(13) || chr(10), '' ORDER BY score DESC, chunk_id) AS context
         FROM hits JOIN documents ON doc_id = chunk_id GROUP BY question_id""",
)
def context(t):
    return retrieval.concat_context(hits(t), chunks(t))
