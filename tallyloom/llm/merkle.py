"""Merkle manifest of a dataset, its trees stored in van Emde Boas order.

Every row is a leaf; leaves of one group (a source) make a tree in which each run of
``FANOUT`` nodes has one parent, and the group's roots make a last tree on top.  A tree is
cut into aligned blocks of ``BLOCK`` levels.  A block is one row of the manifest: all its
digests, root first, laid out by splitting the block recursively at half height, the upper
half before the lower ones.  The place of a node follows from its depth and index alone
(``addresses``), for making the tree and for finding siblings alike.  The roots of the
blocks are the leaves of the next tier, until a tree has one root.

Spark deals the blocks: a group with a third of all rows is as many blocks as it needs,
and no task holds more than one block of each side at a time.
"""

from __future__ import annotations

from binascii import hexlify
from collections.abc import Sequence
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import stored

FANOUT = 3
BLOCK = 7  # levels above the leaves of a block, so 2187 leaves
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
OUTPUTS = ("leaf", "subroot", "root", "path")
_STEP = "struct<left:string,right:string>"
_WIDTH = 32  # bytes of a digest


# The hash of rows


def field(column: Column) -> Column:
    """A value as the hash reads it: its UTF-8 bytes after their count, or ``-`` for NULL."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*columns: Column) -> Column:
    """The digest of a row's values, as lower-case hex."""
    return F.sha2(F.concat(*map(field, columns)), 256)


def folded(path: Column, start: Column) -> Column:
    """The root that a leaf's digest and its siblings lead to."""
    return F.aggregate(path, start, lambda own, step: F.sha2(F.concat(step["left"], own, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings on the path, from the leaf to the root."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


# One block


@lru_cache
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """Per depth, root first, the places of the nodes of a complete tree in van Emde Boas order."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    above = levels // 2
    upper, lower = addresses(above), addresses(levels - above)
    first, size = sum(map(len, upper)), sum(map(len, lower))
    starts = first + size * np.arange(FANOUT**above)
    return upper + tuple((starts[:, None] + depth).ravel() for depth in lower)


def height(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while FANOUT**levels < leaves:
        levels += 1
    return levels


def _size(leaves: int, level: int) -> int:
    return -(-leaves // FANOUT**level)


def grown(digests: np.ndarray, levels: int) -> np.ndarray:
    """All digests of a block over ``digests`` (one row of 32 bytes a leaf); places without a node are zero."""
    places = addresses(levels + 1)
    nodes = np.zeros((sum(map(len, places)), _WIDTH), np.uint8)
    nodes[places[levels][: len(digests)]] = digests
    run = 2 * _WIDTH * FANOUT
    for level in range(levels):
        below = places[levels - level][: _size(len(digests), level)]
        text = hexlify(nodes[below].tobytes())
        parents = b"".join(sha256(text[i : i + run]).digest() for i in range(0, len(text), run))
        above = places[levels - level - 1][: _size(len(digests), level + 1)]
        nodes[above] = np.frombuffer(parents, np.uint8).reshape(-1, _WIDTH)
    return nodes


def siblings(nodes: np.ndarray, leaves: int, levels: int) -> tuple[list[str], list[str], np.ndarray]:
    """Per node below the root the digests before and after it in its run, and which of them each leaf's path takes."""
    places, left, right = addresses(levels + 1), [], []
    taken = np.zeros((leaves, levels), np.int64)
    wide = 2 * _WIDTH
    for level in range(levels):
        n = _size(leaves, level)
        taken[:, level] = len(left) + np.arange(leaves) // FANOUT**level
        text = hexlify(nodes[places[levels - level][:n]].tobytes()).decode()
        for j in range(n):
            start = j - j % FANOUT
            left.append(text[wide * start : wide * j])
            right.append(text[wide * (j + 1) : wide * min(start + FANOUT, n)])
    return left, right, taken


# Trees of any size


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, _WIDTH)


def _levels(leaves_of_tree: int, block: int) -> int:
    return min(block, height(leaves_of_tree))


def placed(items: DataFrame, order: list[str]) -> DataFrame:
    """``items`` with their ``place`` (from 0) in their ``tree`` and its ``n``, numbered in ranges rather than in one task."""
    ranged = stored(items.repartitionByRange("tree", *order).withColumn("range", F.spark_partition_id()), "leaves")
    counts = ranged.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("here"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "tree", "range", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"), F.sum("here").over(tree).alias("n")
    )
    inside = F.row_number().over(Window.partitionBy("tree", "range").orderBy(*order))
    numbered = ranged.withColumn("inside", inside).join(counts, ["tree", "range"])
    return numbered.withColumn("place", F.col("before") + F.col("inside") - 1).drop("range", "before", "inside")


def _build(rows: DataFrame, block: int) -> DataFrame:
    """The blocks of one tier: ``(tree, block, n, nodes, top)``; ``n`` counts the tier's nodes of the tree, ``top`` is the block's root."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        nodes = grown(_digests(group["digest"]), _levels(group["n"][0].as_py(), block))
        row = {c: [group[c][0].as_py()] for c in ("tree", "block", "n")}
        return pa.table(row | {"nodes": pa.array([nodes.tobytes()], pa.binary()), "top": pa.array([nodes[0].tobytes()], pa.binary())})

    narrow = rows.select("tree", "block", "place", "n", "digest")
    return narrow.groupBy("tree", "block").applyInArrow(run, "tree string, block long, n long, nodes binary, top binary")


def forest(rows: DataFrame, block: int) -> list[tuple[DataFrame, DataFrame]]:
    """The tiers of all trees over placed ``rows`` (``tree, place, n, digest``), leaves first, as (rows, blocks)."""
    tiers, wide = [], FANOUT**block
    while True:
        rows = rows.withColumn("block", F.floor(F.col("place") / wide).cast("long"))
        blocks = stored(_build(rows, block), "blocks")
        tiers.append((rows, blocks))
        rows = blocks.where(F.col("n") > wide).select(
            "tree", F.col("block").alias("place"), F.ceil(F.col("n") / wide).cast("long").alias("n"), F.col("top").alias("digest")
        )
        if rows.isEmpty():
            return tiers


def roots(tiers: list[tuple[DataFrame, DataFrame]], block: int) -> DataFrame:
    """``(tree, digest)`` of every tree."""
    last = [blocks.where(F.col("n") <= FANOUT**block).select("tree", F.col("top").alias("digest")) for _, blocks in tiers]
    out = last[0]
    for more in last[1:]:
        out = out.unionByName(more)
    return out


def _retrieve(rows: DataFrame, blocks: DataFrame, constant: Sequence[str], height_of_block: int) -> DataFrame:
    """``rows`` with their ``path``, the siblings within the block before those ``above`` it, and the block's ``constant`` columns."""
    rows_columns, keys = rows.columns, ("tree", "block")
    schema = T.StructType([*rows.schema, *(blocks.schema[c] for c in constant), T.StructField("path", T.ArrayType(T.StructType.fromDDL("left string, right string")))])

    def run(leaves: pa.Table, block: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("place").select(rows_columns)
        n, levels = len(leaves), _levels(block["n"][0].as_py(), height_of_block)
        nodes = np.frombuffer(block["nodes"][0].as_py(), np.uint8).reshape(-1, _WIDTH)
        left, right, taken = siblings(nodes, n, levels)
        above = block["above"][0].as_py()
        taken = np.hstack([taken, np.tile(len(left) + np.arange(len(above)), (n, 1))]).astype(np.int32)
        left += [s["left"] for s in above]
        right += [s["right"] for s in above]
        flat = pa.array(taken.ravel())
        steps = pa.StructArray.from_arrays([pa.array(side, pa.string()).take(flat) for side in (left, right)], ["left", "right"])
        starts = pa.array(np.arange(n + 1, dtype=np.int32) * taken.shape[1])
        for c in constant:
            leaves = leaves.append_column(c, pa.array([block[c][0].as_py()] * n, block[c].type))
        return leaves.append_column("path", pa.ListArray.from_arrays(starts, steps))

    return rows.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(run, schema)


def paths(tiers: list[tuple[DataFrame, DataFrame]], above: DataFrame, constant: Sequence[str], block: int) -> DataFrame:
    """The leaf rows with their ``path`` to the root and on along what lies ``above`` their tree (``tree, above`` and ``constant``)."""
    upper = None
    for rows, blocks in reversed(tiers):
        known = blocks.where(F.col("n") <= FANOUT**block).join(above, "tree")
        if upper is not None:
            known = known.unionByName(blocks.join(upper, ["tree", "block"]))
        found = _retrieve(rows, known.select("tree", "block", "n", "nodes", "above", *constant), constant, block)
        upper = found.select("tree", F.col("place").alias("block"), F.col("path").alias("above"), *constant)
    return found


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    tree: str = "source",
    key: str = "doc_id",
    carry: Sequence[str] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """The rows' ``carry`` columns (by default ``key``) with ``leaf``, ``subroot``, ``root`` and ``path``.

    ``leaf`` hashes ``columns``, NULL apart from empty; ``subroot`` is the root of the rows
    with the same ``tree`` value (NULL is one of its own and the first), ``root`` the
    root over the subroots in bytewise order.  ``path`` lists from leaf to root the
    digests ``left`` and ``right`` of a node in its run; ``folded`` applies them.  Leaves go
    by ``key``, NULL first, then by digest; rows alike in both hold neighbouring places in
    no order that matters.  ``block`` is the height of the stored blocks, which changes no result.  No rows make no tree.  A carried column named like an output is
    replaced.
    """
    carried = [c for c in carry or [key] if c not in OUTPUTS]
    name = F.when(F.col(f"`{tree}`").isNull(), F.lit("")).otherwise(F.concat(F.lit(":"), F.col(f"`{tree}`").cast("string")))
    own = F.struct(*(F.col(f"`{c}`") for c in carried)) if carried else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(
        name.alias("tree"),
        F.col(f"`{key}`").alias("key"),
        F.unhex(leaf(*(F.col(f"`{c}`") for c in columns))).alias("digest"),
        own.alias("own"),
        F.monotonically_increasing_id().alias("at"),
    )
    # Stored before it is ranged, so that ``at`` is settled and tells repeated rows apart.
    leaves = stored(placed(stored(rows, "rows"), ["key", "digest", "at"]).select("tree", "place", "n", "digest", "own"), "placed")
    tiers = forest(leaves, block)
    subroots = roots(tiers, block).withColumnRenamed("tree", "name")
    top = stored(placed(subroots.withColumn("tree", F.lit("")), ["name"]), "subroots")
    crown = forest(top, block)
    root = roots(crown, block).select("tree", F.hex("digest").alias("root"), F.array().cast(f"array<{_STEP}>").alias("above"))
    above = paths(crown, root, ["root"], block).select(
        F.col("name").alias("tree"), F.col("path").alias("above"), "root", F.hex("digest").alias("subroot")
    )
    found = paths(tiers, stored(above, "above"), ["subroot", "root"], block)
    return found.select(
        *(F.col(f"own.`{c}`") for c in carried), F.lower(F.hex("digest")).alias("leaf"), F.lower("subroot").alias("subroot"), F.lower("root").alias("root"), "path"
    )


SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, text,
    concat(coalesce(octet_length(encode(doc_id::VARCHAR))::VARCHAR || ':' || doc_id, '-'),
      coalesce(octet_length(encode(source))::VARCHAR || ':' || source, '-'), coalesce(octet_length(encode(lang))::VARCHAR || ':' || lang, '-'),
      coalesce(octet_length(encode(n_chars::VARCHAR))::VARCHAR || ':' || n_chars, '-')) AS head,
    -- CRC-32 by bit, as the engine has no function for it
    list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(0, length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i::INT + 1, 1))::UBIGINT)),
      lambda c, v: list_reduce(list_prepend(xor(c, v), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END)) AS crc
  FROM documents
), f AS (
  SELECT *, CASE WHEN xor(crc, 4294967295::UBIGINT) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM d
), l AS (
  SELECT r, doc_id, coalesce(':' || source, '') AS tree, sha256(head || coalesce(octet_length(encode(text))::VARCHAR || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(octet_length(encode(other))::VARCHAR || ':' || other, '-')) AS tampered FROM f
), p AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf, r) - 1 AS place FROM l
), t AS (
  SELECT tree, 0 AS level, place AS i, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM p
  UNION ALL
  SELECT tree, level + 1, i, sha256(string_agg(h, '' ORDER BY j)), any_value(n) FROM
    (SELECT tree, level, i // 3 AS i, i AS j, h, (n + 2) // 3 AS n FROM t WHERE n > 1) GROUP BY tree, level, i
), s AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree COLLATE "C") - 1 AS place FROM t WHERE n = 1
), u AS (
  SELECT 0 AS level, place AS i, subroot AS h, count(*) OVER () AS n FROM s
  UNION ALL
  SELECT level + 1, i, sha256(string_agg(h, '' ORDER BY j)), any_value(n) FROM
    (SELECT level, i // 3 AS i, i AS j, h, (n + 2) // 3 AS n FROM u WHERE n > 1) GROUP BY level, i
), run AS (
  -- per node the digests before and after it in its run, the trees' levels first, then those on top
  SELECT a.tree, a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS x, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS y
  FROM t a JOIN t b ON a.tree = b.tree AND a.level = b.level AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY ALL
), top AS (
  SELECT a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS x, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS y
  FROM u a JOIN u b ON a.level = b.level AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY ALL
), step AS (
  SELECT p.r, run.level AS k, run.x, run.y FROM p JOIN run ON run.tree = p.tree AND run.i = p.place // (3 ** run.level)::BIGINT
  UNION ALL SELECT p.r, 1000 + top.level, top.x, top.y FROM p JOIN s ON s.tree = p.tree JOIN top ON top.i = s.place // (3 ** top.level)::BIGINT
), path AS (
  SELECT r, list({'x': x, 'y': y} ORDER BY k) AS path, string_agg(x || y, '' ORDER BY k) AS all_of FROM step GROUP BY r
), fold AS (
  SELECT p.r, 1 AS k, p.tampered AS h, coalesce(path.path, []) AS path FROM p LEFT JOIN path ON path.r = p.r
  UNION ALL SELECT r, k + 1, sha256(path[k].x || h || path[k].y), path FROM fold WHERE k <= len(path)
)
SELECT p.doc_id, p.leaf, s.subroot, root.h AS root, sha256(coalesce(path.all_of, '')) AS proof_sha256, fold.h AS folded_root, fold.h = root.h AS verified
FROM p JOIN s ON s.tree = p.tree JOIN (SELECT h FROM u WHERE n = 1) root ON true LEFT JOIN path ON path.r = p.r JOIN fold ON fold.r = p.r AND fold.k = len(fold.path) + 1
"""
