"""Runs a registered query and its SQL side by side."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, float):
        return ("n", "nan") if math.isnan(value) else ("n", round(value, 6))
    if isinstance(value, int):
        return ("n", float(value))
    if isinstance(value, (list, tuple)):
        return ("l", tuple(_cell(v) for v in value))
    return ("s", str(value))


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_cell(row[i]) for i in order) for row in rows), key=lambda r: str(r)
    )


def compare(spark, con, fn, sql, sf_dir):
    """``(same, message)`` for one key."""
    df = fn(spark, sf_dir)
    got_columns, got = _table(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return bool(got), f"{len(got)} rows, no SQL"
    cursor = con.execute(sql)
    want_columns, want = _table([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return False, f"columns {got_columns} against {want_columns}"
    if got != want:
        extra, missing = list(set(got) - set(want))[:2], list(set(want) - set(got))[:2]
        return False, f"{len(got)} against {len(want)} rows; only here {extra}; only there {missing}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    theirs = {d[0]: str(d[1]).lower() for d in cursor.description}
    odd = {c: (kinds[c], theirs[c]) for c in kinds if "hugeint" in theirs[c] or "decimal" in theirs[c] or "decimal" in kinds[c]}
    if odd:
        return False, f"types {odd}"
    return bool(got), f"{len(got)} rows"


def main() -> None:
    import __spark_entry__ as entry
    from tallyloom.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in wanted or queries:
        start = time.time()
        try:
            ok, message = compare(spark, con, queries[key], oracles.get(key), sf_dir)
        except Exception as error:
            ok, message = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {key:32s} {time.time() - start:6.1f}s {message}", flush=True)
    print(f"{len(wanted or queries)} keys, {bad} bad")


if __name__ == "__main__":
    main()
