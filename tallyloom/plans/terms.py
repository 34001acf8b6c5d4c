"""Business words in questions mapped to columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Business word and the column it stands for.
TERMS = {
    "GMV": "gmv",
    "成交额": "gmv",
    "销售额": "gmv",
    "订单数": "order_cnt",
    "单量": "order_cnt",
    "支付订单": "paid_order_cnt",
    "买家数": "buyer_uv",
    "人数": "buyer_uv",
    "UV": "buyer_uv",
    "客单价": "avg_order_amount",
    "销量": "quantity",
    "销售量": "quantity",
    "优惠": "discount_amt",
    "折扣": "discount_amt",
    "运费": "freight_amt",
    "品牌": "brand",
    "类目": "company_category_path",
    "店铺": "shop_name",
    "商品": "spu_name",
    "SPU": "spu_name",
    "人均单数": "avg_orders_per_user",
    "人均金额": "avg_gmv_per_user",
    "排名": "rank_no",
    "品": "spu_name",
    "货": "spu_name",
    "宝贝": "spu_name",
    "单品": "spu_name",
    "款式": "spu_name",
    "SKU": "spu_name",
    "门店": "shop_name",
    "商家": "shop_name",
    "卖家": "shop_name",
    "牌子": "brand",
    "厂商": "brand",
    "品类": "company_category_path",
    "分类": "company_category_path",
    "品种": "company_category_path",
    "客人": "buyer_uv",
    "用户": "buyer_uv",
    "买家": "buyer_uv",
    "消费者": "buyer_uv",
    "单": "order_cnt",
    "订单": "order_cnt",
    # How a metric is usually asked for.
    "卖了多少钱": "gmv",
    "营收": "gmv",
    "卖了多少件": "quantity",
    "出货量": "quantity",
    "件数": "quantity",
    "平均每单多少钱": "avg_order_amount",
    "单均价": "avg_order_amount",
    "客单": "avg_order_amount",
    "多少人买": "buyer_uv",
    "客群规模": "buyer_uv",
    "用户数": "buyer_uv",
    "实付": "net_pay_amt",
    "到手金额": "net_pay_amt",
    "净收入": "net_pay_amt",
}


def term_pattern(terms: dict[str, str]) -> str:
    """One pattern of all words; at each place the longest wins."""
    return "|".join(re.escape(word) for word in sorted(terms, key=lambda w: (-len(w), w)))


def normalize_terms(questions: DataFrame, text: str = "question", terms: dict[str, str] | None = None) -> DataFrame:
    """One row per question and distinct business word found, with the column it means.

    The dictionary is part of the expression: each text is scanned once where it
    lies, and nothing is joined.
    """
    terms = terms or TERMS
    found = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(term_pattern(terms)), F.lit(0)))
    columns = F.create_map(*[F.lit(part) for pair in terms.items() for part in pair])
    hits = questions.withColumn("term", F.explode(found))
    return hits.withColumn("column_name", F.element_at(columns, F.col("term"))).drop(text)
