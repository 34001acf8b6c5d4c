"""Connected components of a link table by large-star and small-star rounds.

Each round lets every node point its larger neighbours (large star) or its smaller
ones (small star) to the smallest of them; after a logarithmic number of rounds every
node points straight to the smallest node it can reach.  Before and after the stars each task contracts the
links it holds, some at a time, which saves most of the rounds.  Links that fit what a task
contracts at a time need no round at all: one more contraction ends the search.  A round is two grouped
minima and two joins; its links are written to the shared folder, so lineage stays short
and a lost executor costs one round.  Nothing but one pair of numbers a round reaches
the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import stored

HELD = 500_000  # nodes that a task contracts at a time


def _contracted(links: DataFrame) -> DataFrame:
    """Links ``(a, b)``, ``a > b``, that connect the same nodes, each task's own to the smallest node it knows."""
    kinds = [links.schema["a"].dataType.simpleString(), links.schema["b"].dataType.simpleString()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above = {}

        def top(x):
            root = x
            while root in above:
                root = above[root]
            while x in above:
                above[x], x = root, above[x]
                if x == root:
                    break
            return root

        def known(schema):
            nodes = list(above)
            columns = [pa.array(nodes, schema.field("a").type), pa.array([top(x) for x in nodes], schema.field("b").type)]
            return pa.RecordBatch.from_arrays(columns, ["a", "b"])

        schema = None
        for batch in batches:
            schema = batch.schema
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                a, b = top(a), top(b)
                if a != b:
                    above[max(a, b)] = min(a, b)
            if len(above) > HELD:
                yield known(schema)
                above.clear()
        if above:
            yield known(schema)

    return links.select("a", "b").mapInArrow(run, f"a {kinds[0]}, b {kinds[1]}")


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links ``(a, b)``, ``a > b``, after one star."""
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    sides = links.unionByName(turned) if large else links
    least = sides.groupBy("a").agg(F.min("b").alias("_least")).select("a", F.least("a", "_least").alias("_least"))
    pointed = sides.join(least, "a")
    if large:
        moved = pointed.where("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    else:
        moved = pointed.where("b != _least").select(F.col("b").alias("a"), F.col("_least").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("_least").alias("b")))
    return moved.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node in ``links`` ``(a, b)``; ``root`` is the smallest node it reaches.

    Links may be repeated, point either way or to the node itself; a node with no link
    to another is not listed.  NULL ends are ignored.
    """
    clean = links.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
    current = stored(_contracted(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))).distinct(), "links")
    mark = F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))
    seen = current.agg(F.count(F.lit(1)), mark).first()
    few = seen[0] <= HELD // 2  # links have two ends at most, so a task holds them all
    if few:
        current = stored(_contracted(current.coalesce(1)), "links")
    while seen[0] and not few:
        current = stored(_contracted(_star(_star(current, large=True), large=False)).distinct(), "links")
        now = current.agg(F.count(F.lit(1)), mark).first()
        if now == seen:
            break
        seen = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
