"""Windows closed by the watermark, look-ups that change, batches that read their own days only."""

import json
import time
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom import bindings
from tallyloom.plans import marketplace
from tallyloom.registry import streams
from tallyloom.session import RELEASE, exists, folders, shared_folder, work_path
from tallyloom.sinks.tables import write_once
from tallyloom.sources import events, tables
from tallyloom.streaming import keyed_log, revising, run, windows
from tallyloom.streaming.keyed_log import PART, KeyedLog
from tallyloom.streaming.lookup import LookupJoin

START = datetime(2024, 1, 1)
CLICKS = "kind string, value int, event_time timestamp"


def clicks(spark, *rows):
    return spark.createDataFrame([(k, v, None if s is None else START + timedelta(seconds=s)) for k, v, s in rows], CLICKS).coalesce(1)


def totals_of(df, **more):
    return windows.window_totals(df, "1 minute", ["kind"], {"n": F.count(F.lit(1)), "total": F.sum("value")}, **more)


def feed(spark, landing, *batches):
    for batch in batches:
        clicks(spark, *batch).write.mode("append").parquet(landing)
    return events.with_event_watermark(tables.stream_table(spark, landing, T.StructType.fromDDL(CLICKS), files_per_batch=1))


def shown(df):
    return sorted((int((r["window_start"] - START).total_seconds()), r["kind"], r["n"], r["total"]) for r in df.collect())


BATCHES = [
    [("a", 1, 1), ("a", 2, 59), ("b", None, 30), (None, 5, 2), ("a", 7, None)],
    [("a", 3, 58), ("a", 4, 130)],  # 58 is out of order and its window still open: nothing has passed 65 yet
    [("a", 0, 131)],  # the watermark stands at 125 and is applied to what comes from the next batch on
    [("b", 9, 61)],  # the first two windows are closed
    [("a", 100, 20), ("b", 100, 119), ("a", 6, 121)],  # the first two rows are late
]


def test_window_totals_drop_late_rows_only(spark):
    stream = feed(spark, work_path(spark, "clicks"), *BATCHES)
    totals = totals_of(stream)
    table = windows.window_table(work_path(spark, "windows"), totals, ["kind"]).open_empty(spark)
    run.drain(windows.keep_totals(totals, table), work_path(spark, "cp"))
    found = table.current(spark)
    nulls = found.where("kind IS NULL")
    assert [(r["n"], r["total"]) for r in nulls.collect()] == [(1, 5)]
    assert shown(found.where("kind IS NOT NULL")) == [(0, "a", 3, 6), (0, "b", 1, None), (120, "a", 3, 10)]
    mark = F.lit(START + timedelta(seconds=125))
    assert {r["window_start"] for r in windows.closed(found, mark).collect()} == {START}
    on_time = clicks(spark, *BATCHES[0], *BATCHES[1], *BATCHES[2], BATCHES[4][2])
    assert shown(totals_of(on_time).where("kind IS NOT NULL")) == shown(found.where("kind IS NOT NULL"))


def test_windows_may_overlap(spark):
    found = totals_of(clicks(spark, ("a", 1, 10), ("a", 2, 40)), slide="30 seconds")
    assert shown(found) == [(-30, "a", 1, 1), (0, "a", 2, 3), (30, "a", 1, 2)]


def test_closed_windows_leave_the_state_and_are_appended_once(spark):
    landing, out, checkpoint = (work_path(spark, label) for label in ("clicks", "out", "cp"))
    batches = [[("a", i, 60 * i), ("b", i, 60 * i + 1)] for i in range(12)]
    stream = feed(spark, landing, *batches)
    query = run.to_files(totals_of(stream), out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    states = [json.loads(p.json)["stateOperators"][0] for p in query.recentProgress]
    assert max(s["numRowsTotal"] for s in states) <= 6 < 24 and sum(s.get("numRowsRemoved", 0) for s in states) >= 18
    rows = shown(spark.read.parquet(out))
    assert len(rows) == len(set(rows)) and [r for r in rows if r[0] < 540] == [(60 * i, k, 1, i) for i in range(9) for k in "ab"]


def test_repeats_within_the_delay_leave_one_row(spark):
    landing, out = work_path(spark, "clicks"), work_path(spark, "once")
    stream = feed(spark, landing, [("a", 1, 10), ("a", 1, 10)], [("a", 1, 12), ("b", 1, 12)], [("c", 1, 600)], [("c", 1, 601)], [("b", 1, 602)])
    run.drain(run.to_files(events.drop_repeats(stream, ["kind"]), out), work_path(spark, "cp"))
    assert sorted(r["kind"] for r in spark.read.parquet(out).collect()) == ["a", "b", "b", "c"]


def test_look_up_sees_the_dimension_of_its_batch(spark, rows):
    dim = KeyedLog(work_path(spark, "dim"), T.StructType.fromDDL("k int, name string"), ["k"], [], by_arrival=True)
    dim.open(spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string"))
    join = LookupJoin(dim, "k", ["name"], work_path(spark, "facts"))
    facts = T.StructType.fromDDL("id int, k int")

    def batch(*values):
        return spark.createDataFrame(values, facts)

    join.process(batch((1, 1), (2, 2), (3, None), (4, 9)), 0)
    assert join.seen(spark, 1) == -1  # batch 1 begins and is lost before it writes
    dim.append(spark.createDataFrame([(1, "uno"), (9, "nine")], "k int, name string"), 0)
    join.process(batch((5, 1), (6, 9)), 1)
    join.process(batch((7, 1), (8, 9)), 2)
    join.process(batch((7, 1), (8, 9)), 2)
    assert rows(join.result(spark, facts)) == [
        (1, 1, "one"), (2, 2, "two"), (3, None, None), (4, 9, None), (5, 1, "one"), (6, 9, None), (7, 1, "uno"), (8, 9, "nine")
    ]


ROW = "order_id string, shop_id string, shop_name string, order_date string, buyer_uid string, total_pay_amount decimal(16,2), total_discount_amount decimal(16,2), freight_amount decimal(16,2), total_quantity int, pay_status string, proc_time int"


def test_a_batch_reads_the_files_of_its_days_only(spark):
    """Forty days of history, one more day a batch: what a batch looks at does not grow."""
    schema = T.StructType.fromDDL(ROW)
    log = KeyedLog(work_path(spark, "rows"), schema, ["order_id"], ["proc_time"], part=revising.SHOP.part(revising.DAY)).open_empty(spark)
    kept = revising.RevisingSummary(revising.SHOP, log, work_path(spark, "shop"), ("PAID",))
    looked = []
    for day in range(12):
        date = f"2024-01-{day + 1:02d}"
        values = [(f"{day}-{i}", f"s{i % 2}", "n", date, f"b{i}", 5, 0, 1, 1, "PAID", day) for i in range(4)]
        batch = spark.createDataFrame([(*v[:5], *map(Decimal, v[5:8]), *v[8:]) for v in values], schema)
        kept.process(batch, day)
        assert log.parts(spark, day) == [date]
        files = log.history(spark, day + 1, log.parts(spark, day)).select(F.input_file_name().alias("f")).distinct().count()
        looked.append(files)
        plan = log.history(spark, day + 1, [date])._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan and PART in plan.split("PartitionFilters")[1].split("]")[0]
    assert set(looked) == {1}
    assert kept.result(spark).count() == 24


def test_rows_without_a_day_have_a_partition_of_their_own(spark, rows):
    log = KeyedLog(work_path(spark, "log"), T.StructType.fromDDL("k int, day string"), ["k"], [], by_arrival=True, part="day").open_empty(spark)
    log.append(spark.createDataFrame([(1, None), (2, "a b/c"), (3, "x")], "k int, day string"), 0)
    log.append(spark.createDataFrame([(1, None)], "k int, day string"), 1)
    assert sorted(log.parts(spark, 0), key=str) == [None, "a b/c", "x"] and log.parts(spark, 1) == [None]
    assert rows(log.replaced(spark, 1)) == [(1, None, -1), (1, None, 1)]
    assert rows(log.current(spark)) == [(1, None), (2, "a b/c"), (3, "x")] and log.last_batch(spark) == 1


def test_summary_refuses_rows_of_other_partitions(spark):
    log = KeyedLog(work_path(spark, "rows"), T.StructType.fromDDL(ROW), ["order_id"], ["proc_time"], part="shop_id")
    with pytest.raises(ValueError, match="shop_id"):
        revising.RevisingSummary(revising.SHOP, log, work_path(spark, "shop"), ("PAID",))


def test_a_folder_is_written_whole_and_once(spark, rows):
    path = work_path(spark, "whole") + "/batch=3"
    write_once(spark.range(3), path)
    before = sorted(p.stat().st_mtime_ns for p in Path(path).iterdir())
    write_once(spark.range(9), path)  # a replay: the folder stays
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)]
    assert sorted(p.stat().st_mtime_ns for p in Path(path).iterdir()) == before
    with pytest.raises(Exception, match="boom"):
        write_once(spark.range(2).select(F.raise_error(F.lit("boom")).alias("id")), path.replace("=3", "=4"))
    assert not Path(path.replace("=3", "=4")).exists()
    assert rows(spark.read.parquet(str(Path(path).parent)).select("id")) == [(0,), (1,), (2,)]


def test_a_replayed_table_is_written_once(spark, rows):
    """Four slices in the order of arrival, rows without a place first, from one copy of the rows."""
    schema = T.StructType.fromDDL("id int, at int")
    df = spark.createDataFrame([(i, None if i % 10 == 9 else 100 - i) for i in range(40)], schema)
    seen, before = {}, set(folders(spark, shared_folder(spark))) if exists(spark, shared_folder(spark)) else set()
    holder = type("Tables", (), {"spark": spark})
    streams.replayed(holder, df, "at", "slices", lambda stream: run.each_batch(stream, lambda batch, n: seen.setdefault(n, rows(batch))))
    assert sorted((r for batch in seen.values() for r in batch), key=str) == rows(df)
    assert len(seen) == 4 and {r[0] for r in seen[0]} >= {9, 19, 29, 39}
    placed = [[at for _, at in seen[n] if at is not None] for n in range(4)]
    assert all(max(a) < min(b) for a, b in zip(placed, placed[1:]))
    written = 0
    for name in set(folders(spark, shared_folder(spark))) - before:
        if name.startswith("slices"):
            path = f"{shared_folder(spark)}/{name}"
            written += spark.read.option("recursiveFileLookup", True).schema(schema).parquet(path).count()
    assert written == df.count()


def test_an_empty_table_is_replayed(spark):
    seen = []
    holder = type("Tables", (), {"spark": spark})
    df = spark.createDataFrame([], "id int, at int")
    streams.replayed(holder, df, "at", "nothing", lambda stream: run.each_batch(stream, lambda batch, n: seen.append(batch.count())))
    assert sum(seen) == 0


def test_groups_are_published_after_one_exchange(spark, monkeypatch):
    """What a batch publishes moves its changes once, however many distinct counts a group has."""
    schema = T.StructType.fromDDL(
        "order_id string, order_item_id string, spu_id string, spu_name string, brand string, buyer_uid string, quantity int, "
        "item_pay_amount decimal(16,2), discount_amount decimal(16,2), pay_status string, create_time timestamp, version int"
    )
    lines = [(f"o{i % 5}", f"i{i % 7}", f"p{i % 2}", "n", "b", None if i % 3 else f"b{i % 4}", None if i % 2 else 1, Decimal(i), None, "PAID", START, 1) for i in range(20)]
    lines += [("o9", "i1", None, "n", "b", "b1", 1, Decimal(1), None, "PAID", START, 1)]
    log = KeyedLog(work_path(spark, "rows"), schema, ["order_id", "order_item_id"], ["version"], part=revising.SPU.part(revising.YEAR), gather=False)
    kept = revising.RevisingSummary(revising.SPU, log.open_empty(spark), work_path(spark, "spu"), ("PAID",))
    plans = []
    append = kept.published.append
    monkeypatch.setattr(kept.published, "append", lambda rows, n: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), append(rows, n)))
    kept.process(spark.createDataFrame(lines, schema), 0)
    assert plans[0].count("Exchange hashpartitioning") == 1 and "Expand" not in plans[0]
    latest = log.current(spark).where("spu_id IS NOT NULL")
    again = marketplace.dws_spu_daily_sales(latest, ("PAID",), keyed=False)
    assert sorted(map(tuple, kept.result(spark).collect()), key=str) == sorted(map(tuple, again.collect()), key=str)
    kept.process(spark.createDataFrame([(*x[:9], "UNPAID", START, 2) for x in lines if x[2] == "p0"], schema), 1)
    latest = log.current(spark).where("spu_id IS NOT NULL")
    again = marketplace.dws_spu_daily_sales(latest, ("PAID",), keyed=False)
    assert sorted(map(tuple, kept.result(spark).collect()), key=str) == sorted(map(tuple, again.collect()), key=str)


def day_rows(spark, day, *prices, status="PAID"):
    """An order a price, of two shops by turns."""
    schema = T.StructType.fromDDL(ROW)
    rows = [(f"{day}-{i}", f"s{i % 2}", "n", day, f"b{i}", Decimal(p), Decimal(0), Decimal(1), 1, status, 0) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, schema)


def shop_summary(spark):
    log = KeyedLog(work_path(spark, "rows"), T.StructType.fromDDL(ROW), ["order_id"], ["proc_time"], part=revising.SHOP.part(revising.DAY))
    return revising.RevisingSummary(revising.SHOP, log.open_empty(spark), work_path(spark, "shop"), ("PAID",))


def test_large_partitions_are_taken_some_at_a_time(spark, rows, monkeypatch):
    days = [f"2024-01-0{d}" for d in (1, 2, 3)]
    first = day_rows(spark, days[0], 5, 6, 7).union(day_rows(spark, days[1], 1, 2)).union(day_rows(spark, days[2], 9))
    second = day_rows(spark, days[0], 8).union(day_rows(spark, days[1], 1, 2, status="UNPAID")).union(day_rows(spark, None, 3)).withColumn("proc_time", F.lit(1))
    found, steps = [], []
    for size in (keyed_log.STEP_BYTES, 1):
        monkeypatch.setattr(keyed_log, "STEP_BYTES", size)
        kept = shop_summary(spark)
        for n, batch in enumerate((first, second)):
            kept.process(batch, n)
            steps.append(kept.rows.steps(spark, n))
        found.append(rows(kept.result(spark)))
    assert steps == [[days], [[*days[:2], None]], [[day] for day in days], [[days[0]], [days[1]], [None]]]
    assert found[0] == found[1] and {(r[2], r[0], r[5]) for r in found[0]} == {
        (days[0], "s0", Decimal(15)), (days[0], "s1", Decimal(6)), (days[2], "s0", Decimal(9))
    }


def test_new_partitions_are_not_looked_up(spark, rows):
    log = KeyedLog(work_path(spark, "log"), T.StructType.fromDDL("k int, n int, day string"), ["k"], ["n"], part="day").open_empty(spark)
    schema = T.StructType.fromDDL("k int, n int, day string")
    log.append(spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (None, 1, "a"), (2, 1, "b")], schema), 0)
    found = log.replaced(spark, 0)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found) == [(1, 2, "a", 1), (2, 1, "b", 1)]
    log.append(spark.createDataFrame([(1, 3, "a"), (3, 1, "c"), (2, 0, "b")], schema), 1)
    assert rows(log.replaced(spark, 1)) == [(1, 2, "a", -1), (1, 3, "a", 1), (2, 1, "b", -1), (2, 1, "b", 1), (3, 1, "c", 1)]
    assert rows(log.replaced(spark, 0)) == [(1, 2, "a", 1), (2, 1, "b", 1)]


def test_shuffle_files_go_when_their_action_ends(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {p.name for folder in manager.localDirsString() for p in Path(folder).glob("*/shuffle_*")}

    before, left, out = shuffled(), [], work_path(spark, "sums")

    def work(batch, n):
        batch.groupBy("kind").count().write.parquet(f"{out}-{n}")
        for _ in range(100):
            if not shuffled() - before:
                break
            time.sleep(0.1)
        left.append(shuffled() - before)

    setting = spark.conf.get(RELEASE, None)
    run.drain(run.each_batch(feed(spark, work_path(spark, "clicks"), BATCHES[0]), work), work_path(spark, "cp"))
    assert left == [set()] and spark.conf.get(RELEASE, None) == setting
    assert spark.read.parquet(f"{out}-0").count() == 3


def test_lines_become_texts_after_their_joins(spark, rows):
    lineitem = [(1, 10, 7, 1, 2.0, 99.5, 0.1, START), (1, 11, 7, 2, 1.0, 10.0, None, None), (2, 10, 7, 1, 1.0, 1.0, 0.0, START), (None, 10, 7, 1, 1.0, 1.0, 0.0, START)]
    t = type("Tables", (), {
        "lineitem": spark.createDataFrame(lineitem, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp"),
        "orders": spark.createDataFrame([(1, 5, "F", 3.0, START)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp"),
        "part": spark.createDataFrame([(10, "ring", None, "LARGE")], "p_partkey long, p_name string, p_brand string, p_type string"),
    })
    lines = bindings.order_lines(t, "product")
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "concat_ws(-" in plan and "concat_ws(-" not in plan[plan.index("Join"):]
    assert rows(lines, "order_id", "order_item_id", "spu_id", "discount_amount", "shop_id", "buyer_uid", "pay_status", "spu_name", "company_category_path") == [
        ("1", "1-10-7-9950-2-20240101", "10", Decimal("9.95"), "1", "5", "PAID", "ring", "LARGE>ring"),
        ("1", "2-11-7-1000-1", "11", None, "1", "5", "PAID", None, None),
    ]
