"""SimHash near-duplicates found through deletion-variant signatures.

Fingerprints of 64 bits that differ in at most four bits are to be linked.  Cut into
three segments, at least one segment differs in at most one bit.  So each fingerprint is
listed under every segment with every single bit of it left out (64 keys); two segments
that differ in at most one bit share such a key.  Equal keys are joined and the whole
fingerprints compared.

Rows with equal fingerprints are one node, and a pair is only looked at under the first
key that it shares.  Every fingerprint is compared with the ``HUBS`` smallest under each
of its keys, which is every pair of a key that holds no more.  For larger keys the
components found so far come in: some rounds compare with other hubs, and then what is
outside a key's largest component is compared with all that is in another component.  A
large group of near copies is one component by then, so its pairs are never made, and
no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import whole
from tallyloom.llm.components import components
from tallyloom.session import stored

SHINGLE = 4
BITS = 4
SEED = 42
HUBS = 8
ROUNDS = 3  # of other hubs for keys with more nodes than that
PRINT_ROUNDS = 1  # the same for fingerprints, whose pairs cost less to compare than a round does
PLACE = 32  # bits of a key that hold the segment's value
AT_ONCE = 200_000  # shingles counted at a time within one text


def shingle_hashes(words: list[bytes], shingle: int) -> Iterator[list[int]]:
    """XXH64 of the shingles of one text, some at a time; fewer words than a shingle are one shingle."""
    shingle = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
    stops, digest = ends[shingle - 1 :].tolist(), xxhash.xxh64_intdigest
    for at in range(0, len(begins), AT_ONCE):
        yield [digest(joined[a:b], SEED) for a, b in zip(begins[at : at + AT_ONCE], stops[at : at + AT_ONCE], strict=True)]


def majority(parts: Iterable[list[int]]) -> int:
    """The signed 64-bit number whose bits are set in more than half of the hashes."""
    set_bits, n = np.zeros(64, np.int64), 0
    for hashes in parts:
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        set_bits, n = set_bits + bits.sum(axis=0, dtype=np.int64), n + len(hashes)
    return int(np.packbits(2 * set_bits > n).view(">i8")[0])


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text: lower-cased A-Z, words between ASCII white space, repeats included."""
    words = text.encode().lower().split()
    return majority(shingle_hashes(words, shingle)) if words else 0


def fingerprints(docs: DataFrame, text: str = "text", out: str = "_print", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of every whole text; NULL is an empty text, whose fingerprint is zero."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn(out, of(whole(text)))


def as_hex(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def segments(bits: int) -> list[tuple[int, int, int]]:
    """``(low, high, mask)`` of the segments: so many that one has at most one of ``bits`` differences."""
    count = bits // 2 + 1
    bounds = [64 * i // count for i in range(count + 1)]
    return [(low, high, ((1 << (high - low)) - 1) << low) for low, high in zip(bounds, bounds[1:], strict=False)]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask)


def variants(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """``prints`` with ``_key``: every fingerprint ``p`` under each segment with one of its bits left out; the key begins with that bit."""
    keys = []
    for low, high, mask in segments(bits):
        for bit in range(low, high):
            kept = F.shiftrightunsigned(F.col("p").bitwiseAND(_signed(mask & ~(1 << bit))), low)
            keys.append(F.lit(bit << PLACE).bitwiseOR(kept))
    return prints.select("*", F.explode(F.array(*keys)).alias("_key"))


def linked(a: str, b: str, bits: int) -> Column:
    """Whether two fingerprints are within ``bits`` and ``_key`` is the first key that they share."""
    x = F.col(a).bitwiseXOR(F.col(b))
    first = F.lit(-1)
    for low, _, mask in reversed(segments(bits)):
        part = x.bitwiseAND(_signed(mask))
        bit = F.when(part < 0, 63).otherwise(F.bit_count(part - 1))  # of a part with one bit
        first = F.when(part == 0, low).when(F.bit_count(part) == 1, bit).otherwise(first)
    return (F.bit_count(x) <= bits) & (F.shiftright("_key", PLACE) == first)


def _joined(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with the component ``c`` of their node."""
    return rows.join(roots, rows["p"] == roots["node"]).drop("node").withColumnRenamed("root", "c")


def _crowded(rows: DataFrame) -> DataFrame:
    """The rows of keys with more than ``HUBS`` of them."""
    return rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("_key"))).where(F.col("_n") > HUBS).drop("_n")


def _mixed(placed: DataFrame) -> DataFrame:
    """The rows ``(_key, p, c)`` of keys that hold several components, with the key's largest as ``_main``."""
    key = Window.partitionBy("_key")
    sized = placed.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("_key", "c")))
    ends = {"_main": F.max(F.struct("_n", "c")).over(key)["c"], "_least": F.min("c").over(key), "_most": F.max("c").over(key)}
    return sized.withColumns(ends).where("_least < _most").drop("_n", "_least", "_most")


def _outside(placed: DataFrame) -> DataFrame:
    """The rows ``(_key, hub, _c)`` that are outside the largest component of their key; their other columns get ``_hub`` appended."""
    return _as_hubs(_mixed(placed).where("c != _main").drop("_main"))


def _as_hubs(rows: DataFrame) -> DataFrame:
    names = {"p": "hub", "c": "_c"}
    return rows.withColumnsRenamed({c: names.get(c, f"{c}_hub") for c in rows.columns if c != "_key"})


def _rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``(node, root)`` of all ``nodes`` (``p``), stored; one without links is its own root."""
    found = components(links)
    return stored(nodes.join(found, nodes["p"] == found["node"], "left").select(F.col("p").alias("node"), F.coalesce("root", "p").alias("root")), "roots")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after ``links`` between roots; only those enter the search for components."""
    found = components(links).toDF("_old", "_new")
    return stored(roots.join(found, roots["root"] == found["_old"], "left").select("node", F.coalesce("_new", "root").alias("root")), "roots")


def classes(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """``(node, root)`` of the different fingerprints ``p``: what links of ``bits`` or fewer connect has one root."""
    listed = variants(prints, bits).repartition("_key")
    place = F.row_number().over(Window.partitionBy("_key").orderBy("p"))
    hubs = listed.withColumn("_n", place).where(F.col("_n") <= HUBS).select("_key", F.col("p").alias("hub"))
    near = listed.join(hubs, "_key").where((F.col("p") > F.col("hub")) & linked("p", "hub", bits))
    roots = _rooted(prints, near.select(F.col("hub").alias("a"), F.col("p").alias("b")))

    members = stored(_crowded(listed).select("p").distinct(), "members")  # under keys whose pairs are not all compared yet
    if members.isEmpty():
        return roots
    for turn in range(PRINT_ROUNDS + 1):
        # A fingerprint gets its root before it is listed under its keys, so a crowd is joined once, not once a key.  All
        # nodes of the keys in question are members, so that counting tells these keys from the members' other ones.
        placed = variants(members.join(roots, members["p"] == roots["node"]).select("p", F.col("root").alias("c")), bits)
        mixed = stored(_mixed(_crowded(placed.repartition("_key"))), "mixed")
        if mixed.isEmpty():
            break
        outside = _as_hubs(mixed.where("c != _main").drop("_main"))
        if turn < PRINT_ROUNDS:  # some of them first; the last turn takes all
            order = Window.partitionBy("_key").orderBy(F.xxhash64("hub", F.lit(turn)))
            outside = outside.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= HUBS).drop("_n")
        near = mixed.drop("_main").join(outside, "_key").where((F.col("c") != F.col("_c")) & linked("p", "hub", bits))
        roots = _merged(roots, near.select(F.col("c").alias("a"), F.col("_c").alias("b")))
        members = mixed.select("p").distinct()
    return roots


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, bits: int = BITS, carry: list[str] | None = None
) -> DataFrame:
    """``docs`` (its columns ``carry``, by default all) with ``_print`` (long) and ``component_id``.

    ``component_id`` is the smallest key that links of ``bits`` or fewer reach.  Texts
    without words have fingerprint zero and are linked like any other; a text of fewer
    words than a shingle is one shingle.  Rows that repeat a key or a text are kept and
    share their component.  A NULL key names no component, unless all of its keys are
    NULL.  Columns named ``_print`` or ``component_id`` are replaced.
    """
    docs = docs.drop("_print", "component_id")
    printed = fingerprints(docs, text, "_print", shingle)
    printed = stored(printed.select("_print", *(F.col(f"`{c}`") for c in carry or docs.columns)), "prints")
    nodes = stored(printed.groupBy(F.col("_print").alias("p")).agg(F.min(key).alias("_id")), "nodes")
    rooted = nodes.join(classes(nodes.select("p"), bits).toDF("p", "_root"), "p")
    named = rooted.groupBy("_root").agg(F.min("_id").alias("component_id"))
    found = stored(rooted.join(named, "_root").select("p", "component_id"), "classes")
    return printed.join(found, printed["_print"] == found["p"]).drop("p")


def shared_keys(listed: DataFrame) -> DataFrame:
    """``(_key, node, n)`` of the keys that ``n`` > 1 nodes share, stored; of keys with the same nodes one stays."""
    prints = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"_x{i}") for i in range(2)]
    sizes = listed.groupBy("_key").agg(F.count(F.lit(1)).alias("n"), *prints).where("n > 1")
    kept = sizes.groupBy("n", "_x0", "_x1").agg(F.min("_key").alias("_key"))
    return stored(listed.join(kept.select("_key", "n"), "_key"), "keyed")


def verified_classes(nodes: DataFrame, keyed: DataFrame, may: Column, alike: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``(node, root)`` of ``nodes`` (``p``) by the pairs with a common key in ``keyed`` (``_key, p, n``) that ``alike`` keeps.

    ``may`` refutes most pairs while they are joined: a condition on the other columns of ``keyed`` and the same
    with ``_hub`` appended.  A pair counts as connected by verified links only, so at the
    end each pair of a key is verified, refuted, or inside one component.
    """

    def hubs(rows: DataFrame, *order: Column) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("_key").orderBy(*order))
        return rows.withColumn("_n", place).where(F.col("_n") <= HUBS).drop("_n")

    first = hubs(_as_hubs(keyed.drop("n")), F.col("hub"))
    pairs = keyed.join(first, "_key").where((F.col("p") > F.col("hub")) & may).select(F.col("hub").alias("a"), F.col("p").alias("b"))
    tested = stored(pairs.distinct(), "pairs")
    roots = _rooted(nodes, alike(tested))
    large = keyed.where(F.col("n") > HUBS + 1).drop("n")  # smaller keys have all their pairs
    if large.isEmpty():
        return roots
    for turn in range(ROUNDS + 1):
        placed = stored(_joined(large, roots), "placed")
        outside = stored(_outside(placed), "outside")
        if outside.isEmpty():
            break
        if turn < ROUNDS:  # some of them first; the last turn takes all
            outside = hubs(outside, F.xxhash64("hub", F.lit(turn)))
        pairs = placed.join(outside, "_key").where((F.col("c") != F.col("_c")) & may).select(F.least("p", "hub").alias("a"), F.greatest("p", "hub").alias("b"))
        pairs = stored(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        found = alike(pairs)
        ends = found.join(roots.toDF("a", "_ra"), "a").join(roots.toDF("b", "_rb"), "b")
        roots = _merged(roots, ends.select(F.col("_ra").alias("a"), F.col("_rb").alias("b")))
        tested = tested.unionByName(pairs)
    return roots


NEAR_SHINGLE, NEAR_SIMILARITY = 5, 0.8
# Keys of a set, and minima in each: a pair of similarity 0.8 shares none six times in 10,000, one of 0.85 three
# times in 10**6; of pairs of similarity 0.5 one in seven shares a key, of 0.3 one in 400.
BANDS, DEPTH = 40, 8
SKETCH = 1024  # bits of the parities that bound a difference of sets from below
_MULTIPLIERS = np.random.default_rng(SEED).integers(1 << 63, size=(BANDS * DEPTH, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """The different shingles of one text as sorted 32-bit hashes."""
    words = text.encode().lower().split()
    parts = [np.array(h, np.uint64).astype(np.uint32) for h in shingle_hashes(words, shingle)] if words else []
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint32)


def band_keys(own: np.ndarray) -> list[int]:
    """A key of each band: its number and the minima of its hash functions over a set that is not empty."""
    x = own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    least = np.full((BANDS * DEPTH, 1), np.uint64(2**64 - 1))
    for at in range(0, len(x), 2000):
        least = np.minimum(least, (x[at : at + 2000] * _MULTIPLIERS).min(axis=1, keepdims=True))
    least = np.ascontiguousarray(least.reshape(BANDS, DEPTH))
    return [xxhash.xxh64_intdigest(row.tobytes(), band) - (1 << 63) for band, row in enumerate(least)]


def parities(own: np.ndarray) -> list[int]:
    """Whether the set has an odd number of hashes in each of ``SKETCH`` classes, as 64-bit numbers.

    Two sets differ in at least as many hashes as their parities in bits.
    """
    bits = np.bincount(own % SKETCH, minlength=SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(">i8").tolist()


def print_keys(held: DataFrame) -> DataFrame:
    """``(_key, node)``: the class of the fingerprint ``p`` of every ``_node`` of ``held`` as a key."""
    held = stored(held, "held")
    return held.join(classes(held.select("p").distinct()).toDF("p", "_root"), "p").select(F.xxhash64(F.lit("print"), "_root").alias("_key"), F.col("_node").alias("node"))


def one_of_each(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    shingle: int = NEAR_SHINGLE,
    similarity: float = NEAR_SIMILARITY,
) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the smallest key (NULL is largest).

    A link stands if two sets of ``shingle``-word shingles have a Jaccard ``similarity`` or
    more.  Candidates are sets whose SimHash fingerprints are in one class of links of
    ``BITS`` bits or fewer, found through deletion variants as by ``near_duplicates``.  Fingerprints of 64 bits
    meet for the closest copies only, so sets that share a key of minima are candidates too.
    Sizes and parities rule out only pairs that cannot be as similar.
    Texts without words are one group.  Of repeated rows one stays.
    """
    names = docs.columns

    @F.pandas_udf("_print long, _node long, _size int, _keys array<long>, _odd array<long>")
    def described(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                own = shingle_set(t, shingle)
                node = xxhash.xxh64_intdigest(own.tobytes(), SEED) - (1 << 63)
                rows.append((fingerprint(t), node, len(own), band_keys(own) if len(own) else [], parities(own)))
            yield pd.DataFrame(rows, columns=["_print", "_node", "_size", "_keys", "_odd"])

    @F.pandas_udf("array<int>")
    def sets(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shingle_set(t, shingle).view(np.int32))

    printed = stored(docs.withColumn("_b", described(whole(text))).select(*(F.col(f"`{c}`") for c in names), "_b.*"), "printed")
    rank = F.coalesce(F.col(key).cast("long"), F.lit(2**63 - 1))
    nodes = stored(printed.groupBy("_node").agg(F.min(rank).alias("_id"), *(F.first(c).alias(c) for c in ("_size", "_keys", "_odd"))), "nodes")
    classed = print_keys(printed.select("_node", F.col("_print").alias("p")).distinct())
    keyed = shared_keys(nodes.select(F.explode("_keys").alias("_key"), F.col("_node").alias("node")).unionByName(classed.distinct()))

    ends = keyed.select(F.col("node").alias("_node")).distinct()
    seen = printed.select("_node", rank.alias("_id"), whole(text).alias("_t")).join(nodes.select("_node", "_id"), ["_node", "_id"]).join(ends, "_node")
    shingles = stored(seen.dropDuplicates(["_node"]).select("_node", sets("_t").alias("_w")), "shingles")
    sketched = keyed.join(nodes.select(F.col("_node").alias("node"), "_size", "_odd"), "node").withColumnRenamed("node", "p")

    apart = F.lit(0)
    for i in range(SKETCH // 64):
        apart = apart + F.bit_count(F.col("_odd")[i].bitwiseXOR(F.col("_odd_hub")[i]))
    # Of n shingles in both sets together, similar ones differ in n * (1 - s) / (1 + s) at most.
    most = (F.col("_size") + F.col("_size_hub")) * (1 - similarity) / (1 + similarity) + 1e-6
    may = (F.abs(F.col("_size") - F.col("_size_hub")) <= most) & (apart <= most)

    def alike(pairs: DataFrame) -> DataFrame:
        sided = pairs.join(shingles.toDF("a", "_wa"), "a").join(shingles.toDF("b", "_wb"), "b")
        both_have = F.size(F.array_intersect("_wa", "_wb"))
        return sided.where(both_have >= similarity * (F.size("_wa") + F.size("_wb") - both_have)).select("a", "b")

    roots = verified_classes(nodes.select(F.col("_node").alias("p")), stored(sketched, "sketched"), may, alike)
    placed = nodes.join(roots.toDF("_node", "_root"), "_node").select("_node", "_id", "_root")
    firsts = placed.groupBy("_root").agg(F.min(F.struct("_id", "_node")).alias("f")).select("f.*")
    kept = printed.withColumn("_id", rank).join(stored(firsts, "firsts"), ["_node", "_id"])
    # Rows that repeat the key of the one that stays: seldom any, and only then the texts are grouped.
    if not kept.groupBy("_node").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["_node"])
    return kept.select(*(F.col(f"`{c}`") for c in names))
