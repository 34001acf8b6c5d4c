"""Exact top-k search by inner product: branch and bound over dimension blocks.

Vectors are turned to a vertical layout, one row per dimension, the dimensions with the
most mass first.  A query adds up its products block by block; after each block the
mass that is left, the product of the remaining norms, bounds what a candidate can still
gain or lose.  Candidates whose upper bound is under the k-th best lower bound drop out
and the survivors are compacted, so late blocks touch few of them.

Queries and candidates are dealt to a grid of cells of bounded size; every cell gives
its best ``k`` per query, and these are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP = 20
BLOCK = 16
CANDIDATES, QUERIES = 8192, 16384  # vectors of a cell, each side


def quantised(vector: str, scale: int = 64):
    """``floor(scale * x)`` of every component; NULL for vectors that are NULL or hold a NULL or non-finite number."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(fine, F.transform(x, lambda v: F.floor(v * scale)))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def best(queries: np.ndarray, vectors: np.ndarray, own: list[int | None], ids: np.ndarray, k: int) -> list[tuple[np.ndarray, list[int]]]:
    """For each query the places of its ``k`` best vectors and their exact scores; ``own`` is left out."""
    order = np.argsort(-(vectors.astype(float) ** 2).sum(axis=0), kind="stable")
    tall = np.ascontiguousarray(vectors[:, order].T.astype(float))
    width = len(order)
    cuts = list(range(0, width, BLOCK)) + [width]
    left = [np.sqrt((tall[c:] ** 2).sum(axis=0)) for c in cuts[1:]]
    size = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, width)
    exact, slack = (np.int64 if size < 2**62 else object), 1e-9 * size + 1e-6
    out = []
    for q, skip in zip(queries, own, strict=True):
        x = q[order].astype(float)
        alive = np.arange(len(vectors))
        if skip is not None:
            alive = np.delete(alive, skip)
        partial = np.zeros(len(alive))
        for (low, high), mass in zip(zip(cuts, cuts[1:], strict=False), left, strict=True):
            block = tall[low:high]
            partial += x[low:high] @ (block if len(alive) == block.shape[1] else block[:, alive])
            if len(alive) > k:
                rest = float(np.sqrt((x[high:] ** 2).sum())) * mass[alive]
                floor = np.partition(partial - rest, len(alive) - k)[len(alive) - k]
                kept = partial + rest >= floor - slack
                alive, partial = alive[kept], partial[kept]
        scores = (vectors[alive].astype(exact) @ q.astype(exact)).tolist()
        top = sorted(range(len(alive)), key=lambda i: (-scores[i], ids[alive[i]]))[:k]
        out.append((alive[top], [scores[i] for i in top]))
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int = TOP, key: str = "vec_id", vector: str = "v") -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the ``k`` vectors with the largest inner product per query row.

    ``queries`` are rows of ``vectors``, and a query's own row is no candidate.  Ties go to
    the smaller id.  Vectors are whole numbers; NULL vectors and NULL ids take no part, a
    shorter vector counts as filled with zeros.  Rows that repeat id and vector are
    candidates each and queries each (with equal answers); as at most ``k`` of them can
    be answers, ``k + 1`` are compared.  With fewer candidates than ``k`` all are given.
    """
    unit = F.xxhash64("id", "v")

    def counted(df):
        df = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
        return df.groupBy("id", "v").agg(F.count(F.lit(1)).alias("times")).withColumn("unit", unit)

    rows, asked = counted(vectors), counted(queries)
    n, m = rows.count(), asked.count()
    wide, high = max(1, -(-n // CANDIDATES)), max(1, -(-m // QUERIES))

    def cells(df, own: str, count: int, other: str, others: int):
        spread = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return df.withColumn(own, F.pmod("unit", F.lit(count)).cast("int")).withColumn(other, spread)

    copies = F.explode(F.sequence(F.lit(0), F.least(F.col("times"), F.lit(k + 1)).cast("int") - 1))
    one = cells(asked, "row", high, "col", wide)
    two = cells(rows.withColumn("copy", copies), "col", wide, "row", high)

    def cell(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        q, c = q.sort_values(["id", "unit"]), c.sort_values(["id", "unit", "copy"])
        width = max(q["v"].map(len).max() if len(q) else 0, c["v"].map(len).max() if len(c) else 0)
        first = {(i, u): at for at, (i, u, x) in enumerate(zip(c["id"], c["unit"], c["copy"], strict=True)) if x == 0}
        own = [first.get(x) for x in zip(q["id"], q["unit"], strict=True)]
        ids = c["id"].to_numpy()
        found = best(_matrix(q["v"], width), _matrix(c["v"], width), own, ids, k) if len(q) and len(c) else []
        sizes = [len(f[0]) for f in found]
        at = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
        reps = {name: np.repeat(q[name].to_numpy()[: len(sizes)], sizes) for name in ("id", "unit", "times")}
        return pd.DataFrame({"query_id": reps["id"], "unit": reps["unit"], "times": reps["times"], "vec_id": ids[at], "score": [s for f in found for s in f[1]]})

    local = one.groupBy("row", "col").cogroup(two.groupBy("row", "col")).applyInPandas(
        cell, "query_id long, unit long, times long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id", "unit").orderBy(F.desc("score"), "vec_id")
    top = local.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return top.withColumn("_again", again).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
QUALIFY rank <= 20
"""
