"""Rows at the edges: NULLs, ties, repeats, hot groups, bad JSON, replayed batches."""

import datetime as dt
import math
import random
import re
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.contracts import MARKETPLACE, RETAIL, SERVED, Table, apply_contract
from tallyloom.functions import scalars as s
from tallyloom.operators import access, filters, guard, joins, keyed, ranking, retrieval
from tallyloom.plans import marketplace as m
from tallyloom.plans import metrics, terms
from tallyloom.registry import sources
from tallyloom.session import discard, exists, folders, shared_folder, stored, work_path
from tallyloom.sinks import tables as sinks
from tallyloom.sources import cdc, events, tables
from tallyloom.streaming import revising, run
from tallyloom.streaming.keyed_log import KeyedLog


def frame(spark, ddl, *data):
    return spark.createDataFrame(list(data), ddl)


# --- ranking ------------------------------------------------------------------


def brute_ranks(data):
    out, seen = {}, {}
    for group, value, key in sorted(data, key=lambda r: (r[0], r[1] is None, -(r[1] or 0), r[2])):
        seen[group] = seen.get(group, 0) + 1
        out[(group, key)] = seen[group]
    return out


def test_rank_matches_brute_force(spark):
    rng = random.Random(7)
    data = [("hot" if rng.random() < 0.5 else f"g{rng.randrange(5)}", D(rng.randrange(-500, 5000)), f"k{i:05d}") for i in range(3000)]
    data += [("hot", D(10), f"t{i:03d}") for i in range(200)] + [("hot", None, "n1"), ("hot", None, "n2"), ("g1", D(0), "z")]
    df = frame(spark, "grp string, value decimal(16,2), id string", *data)
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")  # eight ranges although the rows are few
    try:
        assert_ranks(df, data)
    finally:
        spark.conf.unset(merge)


def assert_ranks(df, data):
    got = {(r.grp, r.id): r.rank_no for r in ranking.rank_within(df, "grp", "value", "id").collect()}
    assert got == brute_ranks(data)


def test_rank_keeps_rows_without_group(spark):
    df = frame(spark, "grp string, value int, id string", (None, 1, "a"), (None, 2, "b"), ("x", 3, "c"))
    assert {(r.id, r.rank_no) for r in ranking.rank_within(df, "grp", "value", "id").collect()} == {("a", 2), ("b", 1), ("c", 1)}


def test_first_within_limits_before_the_shuffle(spark):
    df = frame(spark, "grp string, value int, id string", ("a", 1, "x"), ("a", 1, "w"), ("b", 5, "y"))
    best = ranking.first_within(df, "grp", "value", "id")
    assert sorted((r.grp, r.id) for r in best.collect()) == [("a", "w"), ("b", "y")]
    plan = best._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


# --- keyed tables ---------------------------------------------------------------


def test_upsert(spark, rows):
    held = frame(spark, "k int, v string, n int", (1, "old", 9), (2, "old", 9))
    new = frame(spark, "k int, v string, n int", (2, "a", 1), (2, "b", 2), (3, "c", 1))
    assert rows(keyed.upsert(held, new, ["k"], ["n"]), "k", "v") == [(1, "old"), (2, "b"), (3, "c")]


def test_insert_if_absent(spark, rows):
    held = frame(spark, "k int, v string", (1, "old"))
    new = frame(spark, "k int, v string", (1, "new"), (2, "x"), (2, "x"))
    assert rows(keyed.insert_if_absent(held, new, ["k"])) == [(1, "old"), (2, "x")]


def test_update_can_set_null(spark, rows):
    held = frame(spark, "k int, v string", (1, "a"), (2, "b"))
    assert rows(keyed.update_by_key(held, frame(spark, "k int, v string", (2, None)), ["k"], ["v"])) == [(1, "a"), (2, None)]
    assert rows(keyed.delete_by_key(held, held.where("k = 1"), ["k"])) == [(2, "b")]


def test_update_with_repeated_keys_keeps_one_row(spark, rows):
    held = frame(spark, "k int, v string", (1, "a"), (2, "b"), (2, "c"))
    changes = frame(spark, "k int, v string, at int", (2, "new", 9), (2, "old", 3), (2, None, 5), (7, "x", 1), (None, "y", 1))
    assert rows(keyed.update_by_key(held, changes, ["k"], ["v"], ["at"])) == [(1, "a"), (2, "new"), (2, "new")]
    assert rows(keyed.update_by_key(held, changes, ["k"], ["v"])) == [(1, "a"), (2, "old"), (2, "old")]


def test_missing_column(spark, rows):
    df = frame(spark, "k int", (1,))
    assert rows(keyed.add_missing_column(df, "flag", F.lit(0))) == [(1, 0)]
    assert keyed.add_missing_column(df, "k", F.lit(5)) is df


def test_contract_rounds_and_refuses_null_keys(spark, rows):
    table = Table("t", "k string, v decimal(10,2)", ("k",))
    assert rows(apply_contract(frame(spark, "k string, v double, extra int", ("a", 1.005, 1), ("b", 2.675, 1)), table))[0][1] == D("1.01")
    with pytest.raises(Exception, match="NULL in key column t.k"):
        apply_contract(frame(spark, "k string, v double", (None, 1.0)), table, check_keys=True).collect()


# --- change rows ------------------------------------------------------------------


def test_delete_then_create_at_the_same_time(spark, rows):
    held = frame(spark, "id int, v string", (1, "old"), (2, "old"), (3, "old"))
    changes = frame(
        spark,
        "id int, v string, op string, ts int, at int",
        (1, "old", "d", 5, 1),
        (1, "new", "c", 5, 2),
        (2, "x", "u", 5, 1),
        (2, "x", "d", 6, 2),
    )
    assert rows(cdc.cdc_apply(held, changes, ["id"], ["ts", "at"])) == [(1, "new"), (3, "old")]
    assert rows(cdc.snapshot_then_changes(held, changes, ["id"], ["ts", "at"]), "id", "v") == [(1, "new"), (3, "old")]


def test_change_messages(spark, rows):
    row = T.StructType.fromDDL("id bigint, v decimal(6,2)")
    texts = [
        ('{"before":null,"after":{"id":1,"v":2.5},"op":"c"}',),
        ('{"before":{"id":1,"v":2.5},"after":{"id":1,"v":3},"op":"u"}',),
        ('{"before":{"id":1,"v":3},"after":null,"op":"d"}',),
        ('{"after":{"id":2},"op":"r"}',),
        ('{"after":{"id":2},"op":"x"}',),
        ("broken",),
    ]
    got = rows(cdc.decode_changes(spark.createDataFrame(texts, "value string"), row))
    assert got == [("c", 1, D("2.50")), ("d", 1, D("3.00")), ("r", 2, None), ("u", 1, D("3.00"))]


# --- JSON ---------------------------------------------------------------------------


def test_lenient_json(spark):
    schema = T.StructType.fromDDL("a int, s string, d decimal(6,2), ts timestamp, items array<struct<x:int,y:string>>")
    texts = [
        '{"a":1,"s":"q","d":1.005,"ts":"2024-01-01 00:00:00","items":[{"x":1,"y":"k"},{"x":"bad"}]}',
        '{"a":"12","s":5,"ts":"2024-01-01T00:00:00"}',
        '{"a":"x","items":"nolist","s":{"k":1}}',
        '{"items":[],"a":null,"d":99999}',
        "{}",
    ]
    skipped = ['{"a":1', "5", '[{"a":1}]', "null", "", None]
    df = spark.createDataFrame([(x,) for x in texts + skipped], "value string")
    got = {r.value: r for r in events.decode(df, schema, keep=["value"]).collect()}
    assert set(got) == set(texts)
    first, second, third, fourth = (got[x] for x in texts[:4])
    assert (first.a, first.d, [tuple(i) for i in first["items"]]) == (1, D("1.01"), [(1, "k"), (None, None)])
    assert (second.a, second.s, second.ts) == (12, "5", None)
    assert (third.a, third.s, third["items"]) == (None, '{"k":1}', None)
    assert (fourth["items"], fourth.d) == ([], None)
    iso = events.decode(df, schema, events.ISO_CLOCK, keep=["value"]).where("ts IS NOT NULL").collect()
    assert [r.value for r in iso] == [texts[1]]


def test_event_contracts_decode_empty_objects(spark):
    from tallyloom.contracts import EVENTS

    df = spark.createDataFrame([("{}",)], "value string")
    for kind, table in EVENTS.items():
        assert events.with_event_watermark(events.with_proc_time(events.decode_event(df, kind))).columns == [*table.columns, "proc_time"]


# --- marketplace -----------------------------------------------------------------


def test_orders_without_lines_vanish(spark, rows):
    df = frame(
        spark,
        "order_id string, items array<struct<order_item_id:string,pay_amount:decimal(16,2)>>",
        ("a", None),
        ("b", []),
        ("c", [("1", D(5)), ("2", D(6))]),
    )
    assert rows(m.order_detail(df)) == [("c", "1", D("5.00")), ("c", "2", D("6.00"))]


HEAD = (
    "order_id string, shop_id string, shop_name string, order_date string, buyer_uid string, total_pay_amount decimal(16,2), "
    "total_discount_amount decimal(16,2), freight_amount decimal(16,2), total_quantity int, pay_status string"
)


def test_shop_day_with_nulls(spark, rows):
    df = frame(
        spark,
        HEAD,
        ("1", "s", "n1", "2024-01-01", "b1", D(10), D(1), D(2), 1, "已支付"),
        ("2", "s", "n2", "2024-01-01", None, D(20), D(1), None, 2, "已支付"),
        ("3", "s", "n9", "2024-01-01", "b9", D(99), D(1), D(1), 9, "other"),
    )
    want = [("s", "n2", "2024-01-01", 2, 1, D("30.00"), D("2.00"), D("2.00"), D("8.00"), D("15.00"), 3)]
    assert rows(m.dws_shop_daily_gmv(df)) == want
    assert rows(m.dws_shop_daily_gmv(df.unionAll(df), keyed=False), "order_cnt", "buyer_uv") == [(2, 1)]


def test_day_without_known_buyers(spark, rows):
    df = frame(spark, HEAD, ("1", "s", "n", "2024-01-01", None, D(10), D(1), D(2), 1, "已支付"))
    assert rows(m.dws_user_daily_activity(df)) == [("2024-01-01", 0, 0, 1, D("10.00"), None, None)]


def test_overview_counts_a_buyer_per_shop(spark, rows):
    df = frame(
        spark,
        HEAD,
        ("1", "s", "n", "2024-01-01", "b", D(10), D(1), D(2), 1, "已支付"),
        ("2", "t", "n", "2024-01-01", "b", D(11), D(1), D(2), 1, "已支付"),
    )
    overview = m.ads_realtime_overview(m.dws_shop_daily_gmv(df))
    assert rows(overview, "buyer_uv", "order_cnt", "avg_order_amount") == [(2, 2, D("10.50"))]


# --- analyst layer ---------------------------------------------------------------


def test_recent_days_and_ranges(spark, rows):
    df = frame(spark, "stat_date string, gmv int", ("2024-02-29", 1), ("2024-03-01", 2), ("2024-02-23", 3), ("2024-02-24", 4))
    assert len(rows(filters.filter_recent_days(df, 7))) == 3
    assert [r[0] for r in metrics.metric_trend(df, "gmv", 2, "2024-03-01").collect()] == ["2024-02-29", "2024-03-01"]
    today = spark.range(3).select(F.date_format(F.date_sub(F.current_date(), F.col("id").cast("int")), s.DAY).alias("stat_date"))
    assert filters.filter_recent_days(today, 2, F.current_date()).count() == 2
    compact = df.withColumn("dt", s.compact_day("stat_date"))
    assert rows(filters.filter_dt_range(compact, "2024-02-24", "20240229"), "gmv") == [(1,), (4,)]


def test_sort_phrases(spark):
    df = frame(spark, "id string, gmv int, order_cnt int, total_quantity int, buyer_uv int", ("a", 10, 1, 1, 9), ("b", 9, 3, 5, 1))
    best = {p: metrics.rank_by_metric(df, ["id"], p, 1).first().id for p in ("卖得最好", "销量最高", "人气最高", "客单价最高")}
    assert best == {"卖得最好": "a", "销量最高": "b", "人气最高": "a", "客单价最高": "a"}


def test_terms_prefer_the_longest_word(spark, rows):
    df = frame(spark, "id int, question string", (1, "支付订单和订单"), (2, "人均单数"), (3, "nothing"))
    assert rows(terms.normalize_terms(df)) == [(1, "支付订单", "paid_order_cnt"), (1, "订单", "order_cnt"), (2, "人均单数", "avg_orders_per_user")]


def test_caps(spark):
    df = spark.range(500)
    assert metrics.row_cap(df, [F.asc("id")], 400).count() == 100
    assert metrics.row_cap(df, [F.asc("id")], 400, detail=True).count() == 200
    assert metrics.row_cap(df, [F.asc("id")]).count() == 10


@pytest.mark.parametrize("block", [2, 1000])
def test_hybrid_topk_matches_brute_force(spark, block):
    rng = random.Random(3)
    pool = ["red", "blue", "green", "shoe", "hat"]
    data = [(i, " ".join(rng.sample(pool, 3)), [rng.uniform(-1, 1) for _ in range(4)] if i % 5 else None) for i in range(60)]
    data += [(60, None, [0.5, -0.2, 0.1, 0.9]), (61, "", None), (62, "red hat", [0.0] * 4), (63, "red hat", [1.0, None, 0.0, 0.0]), (64, "Red HAT hat", None)]
    asked = [(1, "red hat", [0.5, -0.2, 0.1, 0.9]), (2, "Hat, shoe!", None), (3, None, [0.1, 0.1, 0.1, -1.0]), (4, "unknown red", [0.0] * 4), (7, "blue", [1.0, 0.0, 0.0, 0.0])]

    def score(text, vec, question, vector):
        sound = vec and vector and None not in vec and any(vec) and any(vector)
        dot = sum(a * b for a, b in zip(vec, vector)) if sound else 0.0
        size = (sum(a * a for a in vec) * sum(b * b for b in vector)) ** 0.5 if sound else 1.0
        want = set(re.findall(r"\w+", (question or "").lower()))
        overlap = len(set(re.findall(r"\w+", (text or "").lower())) & want) / max(len(want), 1)
        return half_up(half_up(dot / size) * 0.7 + half_up(overlap) * 0.3)

    def half_up(x):
        return math.copysign(math.floor(abs(x) * 1e6 + 0.5) / 1e6, x)

    df = frame(spark, "chunk_id int, text string, vector array<double>", *data, (None, "red hat", [0.5, -0.2, 0.1, 0.9]))
    questions = frame(spark, "question_id int, text string, vector array<double>", *asked, (None, "red", None))
    hits = retrieval.hybrid_topk(df.select("chunk_id", "text"), df.select("chunk_id", "vector").where("chunk_id IS NOT NULL"), questions, block=block)
    got = {(r.question_id, r.chunk_id): r.score for r in hits.collect()}
    best = {q: sorted((-score(t, v, words, vector), i) for i, t, v in data)[:5] for q, words, vector in asked}
    assert got == {(q, i): -x for q, found in best.items() for x, i in found if -x >= 0.3}
    texts = {i: t for i, t, _ in data}
    contexts = {r.question_id: r.context for r in retrieval.concat_context(hits, df.select("chunk_id", "text")).collect()}
    want = {q: "".join(texts[i] + "\r\n\r\n" for x, i in found if -x >= 0.3 and texts[i] is not None) for q, found in best.items()}
    assert {q: c for q, c in contexts.items() if c} == {q: c for q, c in want.items() if c}


def test_texts_are_not_shuffled_for_retrieval(spark):
    df = frame(spark, "chunk_id int, text string, vector array<double>", (1, "a b", [1.0]))
    questions = frame(spark, "question_id int, text string, vector array<double>", (1, "a", [1.0]))
    hits = retrieval.hybrid_topk(df.select("chunk_id", "text"), df.select("chunk_id", "vector"), questions)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in hits._jdf.queryExecution().sparkPlan().toString()
    assert not any("text" in line for line in plan.splitlines() if "Join" in line)
    assert retrieval.hybrid_topk(df.select("chunk_id", "text"), df.select("chunk_id", "vector"), questions.limit(0)).count() == 0


# --- permissions and statements --------------------------------------------------


def test_grants(spark, rows):
    users = frame(spark, "username string, allowed_tables string", ("all", ""), ("some", " a ,,b"), ("none", None))
    asked = frame(spark, "username string, table_name string", ("all", "x"), ("some", "a "), ("some", "c"), ("none", "y"), ("ghost", "a"))
    assert rows(access.authorized_tables(asked, users)) == [("all", "x"), ("none", "y"), ("some", "a ")]
    assert rows(access.unauthorized_tables(asked, users)) == [("ghost", "a"), ("some", "c")]
    assert rows(access.authorized_tables(asked, users, deny_if_empty=True)) == [("some", "a ")]
    assert rows(access.allowed_users(asked, users)) == [("all", True), ("ghost", False), ("none", True), ("some", False)]
    reasons = rows(access.request_audit(asked, users), "username", "authorized", "reason")
    assert ("ghost", False, "unknown user") in reasons and ("some", False, "not granted") in reasons and len(reasons) == 5


def test_rank_within_keeps_null_apart_from_empty(spark, rows):
    df = frame(spark, "day string, v int, id int", (None, 3, 1), ("", 2, 2), ("", 5, 3), (None, 9, 4), ("d", 1, 5), ("d", 1, 6))
    got = rows(ranking.rank_within(df, "day", "v", "id"), "id", "rank_no")
    assert got == [(1, 2), (2, 2), (3, 1), (4, 1), (5, 1), (6, 2)]


@pytest.mark.parametrize(
    ("name", "as_of", "first", "last"),
    [
        ("今天", "2026-03-01", "2026-03-01", "2026-03-01"), ("昨天", "2026-03-01", "2026-02-28", "2026-02-28"),
        ("本周", "2026-03-01", "2026-02-23", "2026-03-01"), ("上周", "2026-03-01", "2026-02-16", "2026-02-22"),
        ("本周", "2026-03-02", "2026-03-02", "2026-03-02"), ("本月", "2026-03-31", "2026-03-01", "2026-03-31"),
        ("上月", "2026-03-31", "2026-02-01", "2026-02-28"), ("上月", "2026-01-15", "2025-12-01", "2025-12-31"),
    ],
)
def test_named_periods(spark, name, as_of, first, last):
    days = spark.sql("SELECT explode(sequence(DATE '2025-11-01', DATE '2026-04-30')) AS day").select(F.col("day").cast("string").alias("stat_date"))
    got = filters.filter_period(days, name, as_of).agg(F.min("stat_date"), F.max("stat_date")).first()
    assert tuple(got) == (first, last)


def test_top_gives_what_is_asked(spark):
    assert ranking.top(spark.range(3000), 1000, F.asc("id")).count() == 1000
    assert ranking.top(spark.range(300), None, F.asc("id")).count() == 300


def test_generated_ids_are_not_cut(spark):
    made = tables.generate_orders(frame(spark, "seq long", (100000011,), (100000012,), (1000001,), (1000002,), (7,)))
    assert made.select("order_id").distinct().count() == made.select("buyer_uid").distinct().count() == 5
    assert made.where("id = 7").first().order_id == "DY2026082000000007"


def test_cents_keep_every_digit(spark):
    paid = frame(spark, "order_amount long, pay_amount long, post_amount long", (9007199254740993, 1, None))
    assert str(events.order_event_amounts(paid, 100).first().order_amount) == "90071992547409.93"


@pytest.mark.parametrize("keyed", [True, False])
def test_line_summaries_with_and_without_keys(spark, keyed):
    lines = frame(
        spark,
        "spu_id string, company_category_id string, company_category_path string, create_time string, order_id string, order_item_id string,"
        "buyer_uid string, spu_name string, brand string, quantity int, item_pay_amount int, discount_amount int, pay_status string",
        ("s", "c", "c>1", "2026-01-01 01:00:00", "o1", "i1", "u1", "n", "b", 1, 10, 1, "PAID"),
        ("s", "c", "c>1", "2026-01-01 02:00:00", "o1", "i2", "u1", "n", "b", 2, 20, 2, "PAID"),
        ("t", "c", "c>2", "2026-01-01 02:00:00", "o1", "i3", "u1", "m", "b", 3, 30, 3, "PAID"),
        ("s", "c", "c>1", "2026-01-01 03:00:00", "o2", "i4", "u1", "n", "b", 4, 40, 4, "PAID"),
        ("s", "c", "c>1", "2026-01-01 03:00:00", "o3", "i5", None, "n", "b", 5, 50, 5, "UNPAID"),
    ).withColumn("create_time", F.col("create_time").cast("timestamp"))
    spu = {r.spu_id: (r.order_cnt, r.sku_sold_cnt, r.quantity, r.buyer_uv) for r in m.dws_spu_daily_sales(lines, ("PAID",), keyed).collect()}
    assert spu == {"s": (2, 3, 7, 1), "t": (1, 1, 3, 1)}
    one = m.dws_category_daily_sales(lines, ("PAID",), keyed).first()
    assert (one.company_category_path, one.order_cnt, one.quantity, one.buyer_uv) == ("c>2", 2, 10, 1)


@pytest.mark.parametrize("statement", ["SELECT * FROM parquet.`/tmp`", "SELECT reflect('java.lang.System', 'lineSeparator')", "SELECT java_method('java.lang.Math', 'random')"])
def test_files_and_java_are_refused(spark, statement):
    with pytest.raises(Exception, match="(?i)not found|cannot be found|not allowed|UNSUPPORTED"):
        guard.readonly_sql(spark, statement)


@pytest.mark.parametrize(
    "statement",
    ["", "  ;", "DELETE FROM t", "SELECT 1; DROP TABLE t", "INSERT INTO t VALUES (1)", "drop table t"],
)
def test_refused_statements(spark, statement):
    with pytest.raises(PermissionError):
        guard.readonly_sql(spark, statement)


def test_a_write_behind_with_does_not_run(spark):
    spark.range(3).createOrReplaceTempView("numbers")
    with pytest.raises(Exception, match="(?i)parse|syntax"):
        guard.readonly_sql(spark, "WITH x AS (SELECT 1 AS id) INSERT INTO numbers SELECT * FROM x")


def test_audit_reads_past_line_breaks(spark):
    log = frame(spark, "statement string", ("\n\tselect 1\n",), (" \n ",), ("\nDROP TABLE t",), (None,), ("SELECT 1;",))
    reasons = [r.reason for r in guard.audit_statements(log).collect()]
    assert reasons == [None, "empty statement", "not a read-only statement", "empty statement", "more than one statement"]


def test_readonly_rows(spark):
    spark.range(500).createOrReplaceTempView("numbers")
    assert guard.readonly_sql(spark, "SELECT id FROM numbers ORDER BY id;").count() == 500
    assert guard.readonly_sql(spark, "SELECT id FROM numbers ORDER BY id;", cap=200).count() == 200
    assert sinks.result_rows(guard.readonly_sql(spark, "with a as (select 1 as one) select * from a -- end"), 10) == {
        "columns": ["one"],
        "data": [{"one": 1}],
        "row_count": 1,
        "truncated": False,
    }
    assert sinks.result_rows(spark.range(5), 3)["truncated"]
    assert guard.readonly_sql(spark, "SHOW TABLES").count() > 0


# --- tables ------------------------------------------------------------------------


def test_partition_overwrite_keeps_other_days(spark, rows):
    table = RETAIL["dws_user_growth_day"]
    path = work_path(spark, "growth")
    sinks.overwrite_partitions(frame(spark, table.ddl, ("20240101", "app", 1), ("20240102", "app", 2)), path, table)
    sinks.overwrite_partitions(frame(spark, table.ddl, ("20240102", "web", 9)), path, table)
    sinks.append_rows(frame(spark, table.ddl, ("20240103", "web", 4)), path, table)
    assert rows(tables.scan_table(spark, path, table), *table.columns) == [
        ("20240101", "app", 1),
        ("20240102", "web", 9),
        ("20240103", "web", 4),
    ]


def test_hot_partition_is_written_by_several_tasks(spark):
    df = spark.range(0, 400000, 1, 8).select(F.lit("20240101").alias("dt"), F.sha2(F.col("id").cast("string"), 256).alias("k"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "1m")
    try:
        path = work_path(spark, "hot")
        sinks.layout(df, ["dt"]).write.partitionBy("dt").parquet(path)
        assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() > 4
    finally:
        spark.conf.unset(size)


def test_catalog(spark):
    name = "loom_check"
    sinks.init_database(spark, name)
    sinks.init_database(spark, name)
    try:
        table = RETAIL["dws_user_growth_day"]
        sinks.create_table(spark, name, table, work_path(spark, "catalog"))
        assert name in tables.list_databases(spark)
        assert tables.list_tables(spark, name).count(table.name) == 1
        assert [c for c, _ in tables.list_columns(spark, table.name, name)] == ["register_channel", "new_user_cnt", "dt"]
        sinks.drop_table(spark, name, table.name)
        sinks.drop_table(spark, name, table.name)
    finally:
        sinks.drop_database(spark, name)


def test_names_and_places():
    assert tables.table_ref("lake.`mall`.orders") == "orders"
    assert tables.warehouse_path("s3://bucket/warehouse/", "mall", "orders") == "s3://bucket/warehouse/mall.db/orders"
    assert "spark.hadoop.fs.s3a.endpoint" in tables.object_store_settings("store.example")


def test_dimension_snapshot(spark):
    from tallyloom.contracts import DIMENSIONS

    for name, table in DIMENSIONS.items():
        path = work_path(spark, name)
        spark.createDataFrame([], table.schema).write.parquet(path)
        assert tables.read_dim(spark, name, path=path).columns == table.columns


def test_generated_orders_are_repeatable(spark):
    numbers = spark.range(1, 101).withColumnRenamed("id", "seq")
    first, again = tables.generate_orders(numbers).collect(), tables.generate_orders(numbers).collect()
    assert first == again and len(first) == 100
    assert first[9].pay_status == "UNPAID" and first[0].order_id == "DY2026082000000001" and first[0].buyer_uid == "buyer_000001"
    assert all(D(2999) <= r.total_amount < D(7999) for r in first)


def test_number_rows(spark):
    got = joins.number_rows(spark.range(2), [range(5), range(5), (0, 2, 3)])
    assert sorted(r.seq for r in got.where("id = 1").collect()) == list(range(1, 76))


def test_left_dim_with_repeats(spark, rows):
    facts = frame(spark, "k string, v int", ("a", 1), ("b", 2), (None, 3))
    dim = frame(spark, "k string, name string", ("a", "x"), ("a", "y"), (None, "n"))
    assert rows(joins.join_left_dim(facts, dim, "k", ["name"], unique=False)) == [("a", 1, "y"), ("b", 2, None), (None, 3, None)]


def test_shared_folder_is_the_cluster_setting(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(folder)
    assert stored(spark.range(3), "three").count() == 3
    assert any(p.name.startswith("three-") for p in Path(shared_folder(spark)).iterdir())


# --- streams ---------------------------------------------------------------------


def test_second_query_on_a_table_is_refused(spark, rows):
    schema = T.StructType.fromDDL("k int, v string")
    log = KeyedLog(work_path(spark, "owned"), schema, ["k"], []).open_empty(spark)
    source = work_path(spark, "owned-source")
    frame(spark, "k int, v string", (1, "a"), (2, "b")).write.parquet(source)
    stream = tables.stream_table(spark, source, schema)
    run.drain(run.each_batch(stream, log.append), work_path(spark, "checkpoint"))
    with pytest.raises(Exception, match="another query"):
        run.drain(run.each_batch(stream, log.append), work_path(spark, "checkpoint"))
    assert rows(log.current(spark)) == [(1, "a"), (2, "b")]
    folded = log.fold(spark, work_path(spark, "folded"))
    run.drain(run.each_batch(stream, folded.append), work_path(spark, "checkpoint"))
    assert rows(folded.current(spark)) == [(1, "a"), (2, "b")]


def test_replayed_batch_changes_nothing(spark, rows):
    log = KeyedLog(work_path(spark, "log"), T.StructType.fromDDL("k int, v string, n int"), ["k"], ["n"]).open_empty(spark)
    log.append(frame(spark, "k int, v string, n int", (1, "a", 1), (1, "b", 2), (2, "x", 1)), 0)
    log.append(frame(spark, "k int, v string, n int", (1, "late", 0), (2, "y", 5)), 1)
    before = rows(log.current(spark))
    log.append(frame(spark, "k int, v string, n int", (1, "late", 0), (2, "y", 5)), 1)
    assert rows(log.current(spark)) == before == [(1, "b", 2), (2, "y", 5)]
    assert rows(log.fold(spark, work_path(spark, "folded")).current(spark)) == before


VERSIONS = HEAD + ", proc_time int"


def version(order, shop, buyer, amount, freight, status, at):
    return (order, shop, f"name {shop}", "2024-01-01", buyer, D(amount), D(1), freight, 1, status, at)


@pytest.mark.parametrize("span", [None, revising.DAY])
def test_revised_groups_equal_the_batch(spark, rows, span):
    batches = [
        [version("1", "s", "b1", 10, D(2), "PAID", 1), version("2", "s", "b1", 20, None, "PAID", 1), version("3", "t", "b2", 5, None, "PAID", 1)],
        [version("1", "t", "b1", 11, D(3), "PAID", 2), version("3", "t", "b2", 5, None, "UNPAID", 2)],
        [version("1", "s", "b1", 99, D(3), "PAID", 1), version("2", "s", "b1", 20, None, "UNPAID", 3)],
    ]
    schema = T.StructType.fromDDL(VERSIONS)
    part = span and revising.SHOP.part(span)
    log = KeyedLog(work_path(spark, "rows"), schema, ["order_id"], ["proc_time"], part=part).open_empty(spark)
    kept = revising.RevisingSummary(revising.SHOP, log, work_path(spark, "shop"), ("PAID",))
    for number, batch in enumerate(batches):
        df = spark.createDataFrame(batch, schema)
        kept.process(df, number)
        kept.process(df, number)
        everything = spark.createDataFrame([r for b in batches[: number + 1] for r in b], schema)
        latest = keyed.latest_per_key(everything, ["order_id"], ["proc_time"])
        if number < 2:
            assert rows(kept.result(spark)) == rows(m.dws_shop_daily_gmv(latest, ("PAID",)))
    # The late version of order 1 is older than the one held, and shop s has no paid order left.
    assert [(r.shop_id, r.gmv, r.buyer_uv) for r in kept.result(spark).collect()] == [("t", D("11.00"), 1)]
    folded = kept.fold(spark, work_path(spark, "folded"))
    assert rows(folded.result(spark)) == rows(kept.result(spark))
    folded.process(spark.createDataFrame([version("4", "t", "b7", 4, None, "PAID", 1)], schema), 3)
    assert [(r.gmv, r.buyer_uv, r.order_cnt) for r in folded.result(spark).collect()] == [(D("15.00"), 2, 2)]


def test_a_started_stream_commits_and_stops(spark, rows):
    path, out = work_path(spark, "in"), work_path(spark, "out")
    spark.range(5).write.parquet(path)
    query = run.start(run.to_files(tables.stream_table(spark, path, spark.range(1).schema), out), work_path(spark, "cp"), "1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(spark.read.parquet(out)) == [(i,) for i in range(5)]


def test_drain_reports_a_failing_batch(spark):
    path = work_path(spark, "in")
    spark.range(5).write.parquet(path)

    def fail(batch, number):
        raise ValueError("no room")

    stream = tables.stream_table(spark, path, spark.range(1).schema)
    with pytest.raises(Exception, match="no room"):
        run.drain(run.each_batch(stream, fail), work_path(spark, "cp"))
    assert not spark.streams.active


def test_a_stream_goes_on_after_a_failure_without_doubling(spark, rows):
    """The driver is lost after a batch was written and before it was committed."""
    path, checkpoint = work_path(spark, "in"), work_path(spark, "cp")
    schema = T.StructType.fromDDL(VERSIONS)
    versions = [version(str(i % 7), "st"[i % 2], f"b{i % 3}", 10 + i, None, "PAID", i) for i in range(21)]
    spark.createDataFrame(versions, schema).repartitionByRange(3, "proc_time").sortWithinPartitions("proc_time").write.option(
        "maxRecordsPerFile", 7
    ).parquet(path)
    log = KeyedLog(work_path(spark, "rows"), schema, ["order_id"], ["proc_time"]).open_empty(spark)
    kept = revising.RevisingSummary(revising.SHOP, log, work_path(spark, "shop"), ("PAID",))
    failures = [1]

    def work(batch, number):
        kept.process(batch, number)
        if number in failures:
            failures.remove(number)
            raise RuntimeError("driver lost")

    def begin():
        stream = tables.stream_table(spark, path, schema, files_per_batch=1)
        run.drain(run.each_batch(stream, work), checkpoint)

    with pytest.raises(Exception, match="driver lost"):
        begin()
    begin()
    latest = keyed.latest_per_key(spark.createDataFrame(versions, schema), ["order_id"], ["proc_time"])
    assert rows(kept.result(spark)) == rows(m.dws_shop_daily_gmv(latest, ("PAID",)))


def test_kafka_source_names_the_missing_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        events.read_kafka(spark, "orders", "broker:9092", group="loom", start="earliest")


def test_served_tables_are_declared():
    assert set(SERVED) <= set(MARKETPLACE)


def test_line_summaries_count_alike_with_and_without_keys(spark, rows):
    """Orders, lines and buyers of keyed lines, in one exchange, against distinct counts; NULL ids count nowhere."""
    rng = random.Random(8)
    lines = []
    for order in range(150):
        buyer = None if order % 11 == 0 else f"b{rng.randrange(9)}"
        for line in range(rng.randrange(1, 4)):
            spu = None if rng.random() < 0.1 else f"p{0 if rng.random() < 0.4 else rng.randrange(5)}"
            number = None if order % 29 == 0 else str(order)
            lines.append((number, f"{order}-{line}", spu, f"name {rng.randrange(2)}", "brand", "c" + str(rng.randrange(3)), f"path {spu}", line + 1, D(order), D(1), buyer, "PAID", "2024-01-0" + str(1 + order % 2)))
    ddl = (
        "order_id string, order_item_id string, spu_id string, spu_name string, brand string, company_category_id string, company_category_path string, "
        "quantity int, item_pay_amount decimal(16,2), discount_amount decimal(16,2), buyer_uid string, pay_status string, day string"
    )
    df = frame(spark, ddl, *lines).withColumn("create_time", F.col("day").cast("timestamp"))
    for summary in (m.dws_spu_daily_sales, m.dws_category_daily_sales):
        assert rows(summary(df, ("PAID",))) == rows(summary(df, ("PAID",), keyed=False))
        plan = summary(df, ("PAID",))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2


def test_ingest_decodes_its_messages_once(spark, monkeypatch):
    """The order table and what arrives share one decoded copy, and the join ranks no message."""
    from tallyloom.registry import sources as raw

    message = '{"order_id": "%s", "total_quantity": %d, "create_time": "2024-01-0%dT00:00:00"}'
    texts = [(message % (k, n, n),) for k, n in [("a", 1), ("a", 2), ("b", 3)]] + [(message.replace('"%s"', "null") % (1, 4),), ("no json",)]
    monkeypatch.setattr(raw, "raw_messages", lambda t: spark.createDataFrame(texts, "value string"))
    found = raw.ingest(None)
    assert sorted((str(r.order_id), r.total_quantity, r.pay_status) for r in found.collect()) == [("None", 1, "PAID"), ("None", 1, "UNPAID"), ("a", 2, "PAID"), ("b", 3, "PAID")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and plan.count("Window [") <= 2  # one in the final plan, one in the initial


def test_upsert_by_keys_first_moves_no_replaced_rows(spark, rows):
    schema = "k int, l string, v string, n int"
    held = spark.createDataFrame([(1, "a", "old", 0), (2, "a", "old", 0), (2, "b", "old", 0), (None, "a", "old", 0), (2, None, "old", 0), (2, None, "old", 0)], schema)
    new = spark.createDataFrame([(2, "a", "x", 1), (2, "a", "y", 2), (9, "a", "z", 1), (None, "a", "z", 1)], schema)
    plain = keyed.upsert(held, new, ["k", "l"], ["n"])
    first = keyed.upsert(held, new.hint("merge"), ["k", "l"], ["n"], keys_first=True)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1  # of the incoming rows
    assert rows(first) == rows(plain) == sorted(
        [(1, "a", "old", 0), (2, "b", "old", 0), (None, "a", "old", 0), (2, None, "old", 0), (2, None, "old", 0), (2, "a", "y", 2), (9, "a", "z", 1), (None, "a", "z", 1)], key=str
    )


def test_ingested_messages_move_the_fields_that_are_read(spark, rows):
    lineitem = [(1, 10, 7, 1, 3.0, 99.5, 0.1, "R", "F", dt.datetime(2024, 1, 1)), (1, 10, 7, 2, 1.0, 5.0, 0.0, "N", "O", dt.datetime(2024, 1, 1)), (2, 10, 7, 1, 2.0, 5.0, None, "N", "O", None)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    before = set(folders(spark, shared_folder(spark))) if exists(spark, shared_folder(spark)) else set()
    found = sources.ingest(type("Tables", (), {"spark": spark, "lineitem": spark.createDataFrame(lineitem, schema)}))
    kept = set(folders(spark, shared_folder(spark))) - before
    assert sorted(name.rsplit("-", 5)[0] for name in kept) == ["decoded", "staying"]
    scans = found._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1:]
    assert all("sku_name" not in scan.split("\n")[0] for scan in scans)
    assert rows(found, "pay_status", "item_cnt", "first_pay_amount", "first_item_id") == [
        ("PAID", -1, None, None), ("PAID", 0, None, None), ("PAID", 2, D("89.55"), "1-10-7-9950-3-20240101")
    ]


def test_only_intermediate_tables_are_discarded(spark):
    kept, path = stored(spark.range(3), "kept"), work_path(spark, "outside") + "/own/table"
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError, match="no intermediate"):
        discard(spark, spark.read.parquet(path))
    discard(spark, kept)
    assert exists(spark, path) and not any(name.startswith("kept-") for name in folders(spark, shared_folder(spark)))
