"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Rows with equal texts are one group and stay together.  Differencing keeps a heap of
partial partitions, each a list of shard sums; the two with the largest spread are
combined, the largest sum of one with the smallest of the other, until one is left.

Where there are more groups than one task should hold, groups are dealt to buckets by a
hash and each bucket is differenced into ``PARTS`` parts, which are the items of the
next level.  Groups so large that they matter to a whole shard skip to the last level,
and so does a spread of ordinary ones, which fill the gaps that the parts leave.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import slots
from tallyloom.session import stored

SHARDS = 8
AT_ONCE = 100_000  # items one task differences
PARTS = 32  # parts a bucket is reduced to
LOOSE = 20_000  # ordinary items that go to the last level as they are
_ITEM = "level int, g long, c long"


def difference(sizes: np.ndarray, k: int) -> np.ndarray:
    """The part (0 to ``k - 1``) of each size; part 0 has the largest sum."""
    heap = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        sums = [0] * k
        sums[0] = int(sizes[i])
        heap.append((-sums[0], len(heap), sums, [[i], *([] for _ in range(k - 1))]))
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        _, _, a, own = heapq.heappop(heap)
        _, _, b, other = heapq.heappop(heap)
        merged = []
        for x in range(k):
            y = k - 1 - x
            long, short = (own[x], other[y]) if len(own[x]) >= len(other[y]) else (other[y], own[x])
            long.extend(short)
            merged.append((a[x] + b[y], long))
        merged.sort(key=lambda m: -m[0])
        made += 1
        heapq.heappush(heap, (merged[-1][0] - merged[0][0], made, [m[0] for m in merged], [m[1] for m in merged]))
    out = np.zeros(len(sizes), np.int32)
    if heap:
        for part, members in enumerate(heap[0][3]):
            out[members] = part
    return out


def _parted(items: DataFrame, bucket, k: int) -> DataFrame:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bytes", "level", "g", "c"], ascending=[False, True, True, True])
        return frame.assign(part=difference(frame["bytes"].to_numpy(), k))

    return items.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(run, f"{_ITEM}, bytes long, bucket long, part int")


def place(items: DataFrame, shards: int = SHARDS, at_once: int = AT_ONCE, loose: int = LOOSE) -> DataFrame:
    """``(level, g, c, shard)`` of stored items ``(level, g, c, bytes)`` with different ``(level, g, c)``."""
    n, total, level = items.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.max("level"), F.lit(0))).first()
    if n <= at_once:
        return _parted(items, F.lit(0).cast("long"), shards).select("level", "g", "c", F.col("part").alias("shard"))
    buckets = -(-2 * n // at_once)
    digest = F.xxhash64("level", "g", "c")
    straight = (F.col("bytes") * (shards * PARTS) > total) | (F.pmod(F.shiftright(digest, 20), F.lit(n)) < loose)
    rest = items.where(~straight)
    parted = stored(_parted(rest, F.pmod(digest, F.lit(buckets)), PARTS), "parted")
    sums = parted.groupBy("bucket", "part").agg(F.sum("bytes").alias("bytes"))
    above = sums.select(F.lit(level + 1).alias("level"), F.col("bucket").alias("g"), F.col("part").cast("long").alias("c"), "bytes")
    placed = stored(place(stored(above.unionByName(items.where(straight)), "items"), shards, at_once, loose), "placed")
    part_shards = placed.where(F.col("level") == level + 1).select(F.col("g").alias("bucket"), F.col("c").cast("int").alias("part"), "shard")
    inner = parted.join(part_shards, ["bucket", "part"]).select("level", "g", "c", "shard")
    return inner.unionByName(placed.where(F.col("level") <= level))


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", key: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``carry``, by default all) with ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``shard`` and ``slot``.

    Rows of equal text, repeated rows among them, share a shard; all NULL texts are one
    group of size 1 each and have no checksum.  Byte sums of the shards come as near to
    equal as the groups allow; shards may stay empty.  ``slot`` counts from 0 without
    gaps in each shard, in no order that matters.  Columns named like an output are
    replaced.
    """
    outputs = ("size", "text_crc32", "shard", "slot")
    docs = docs.drop(*outputs)
    names = [c for c in carry or docs.columns if c not in outputs]
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    group = F.xxhash64(F.col(text), F.col(text).isNull())
    rows = docs.withColumns({"size": size, "text_crc32": F.crc32(text), "_g": group, "_c": F.coalesce(F.crc32(text), F.lit(-1))})
    groups = rows.groupBy("_g", "_c").agg(F.sum("size").alias("bytes"))
    items = stored(groups.select(F.lit(0).alias("level"), F.col("_g").alias("g"), F.col("_c").cast("long").alias("c"), "bytes"), "groups")
    placed = stored(place(items, shards).select(F.col("g").alias("_g"), F.col("c").alias("_c"), "shard"), "shards")
    rows = rows.select(*(F.col(f"`{c}`") for c in names), F.col(key).alias("_key"), "size", "text_crc32", "_g", "_c")
    joined = stored(rows.join(placed, ["_g", "_c"]), "sharded")
    numbered = slots(joined, "shard", F.struct("_key", "_g"), [F.col("_key"), F.col("_g")], "slot")
    return numbered.select(*(F.col(f"`{c}`") for c in names), *outputs)
