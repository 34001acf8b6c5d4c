"""Benchmark decontamination by winnowing.

Texts become word hashes; every ``GRAM`` consecutive words make a gram, and of each
``WINDOW`` consecutive grams the one with the smallest hash is a fingerprint.  Two texts
that share ``GRAM + WINDOW - 1`` words share a window of grams and so choose the same
fingerprint in it.  Documents and benchmark join on fingerprints, and each hit is
extended word by word to both sides; it counts if it reaches the span's full length.
A longer shared span is the union of such hits.

Items shorter than a span cannot be guaranteed by winnowing; they are looked up by the
hash of all their words, one pass over the documents per length that occurs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import NOT_ALNUM, ascii_lower, n_words, whole
from tallyloom.session import stored

SPAN = 10
GRAM = 4
# Below this many different benchmark fingerprints (about 200 bytes each) they are sent to every task.
BROADCAST_ROWS = 200_000
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PLACE = 2**30 - 1  # the low bits of a gram's code hold its place


def hashed_words(text: str) -> Column:
    words = F.array_remove(F.split(ascii_lower(whole(text)), NOT_ALNUM), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _fingerprints(hashes: DataFrame, span: int, gram: int) -> DataFrame:
    """``hashes`` (with ``_h``) exploded to the places ``_pos`` of its fingerprints ``_fp``, with the words around."""
    window = span - gram + 1

    def code(word, i):
        grams = F.xxhash64(word, *(F.get("_h", i + j) for j in range(1, gram)))
        return grams.bitwiseAND(F.lit(~PLACE)).bitwiseOR(F.lit(PLACE) - i)

    grams = F.transform(F.slice("_h", F.lit(1), F.greatest(F.lit(0), F.size("_h") - (gram - 1))), code)
    coded = hashes.withColumn("_codes", grams)
    smallest = F.transform("_codes", lambda _, i: F.array_min(F.slice("_codes", i + 1, F.lit(window))))
    chosen = coded.withColumn("_chosen", F.array_distinct(smallest)).drop("_codes")
    # The outer form keeps Spark from testing the array's size below, which would repeat its expression per word.
    rows = chosen.withColumn("_code", F.explode_outer("_chosen")).drop("_chosen").where("_code IS NOT NULL")
    rows = rows.withColumn("_pos", (F.lit(PLACE) - F.col("_code").bitwiseAND(PLACE)).cast("int"))
    around = F.array(*(F.get("_h", F.col("_pos") + d) for d in range(1 - window, gram + window - 1)))
    return rows.select(
        *(c for c in hashes.columns if c != "_h"), "_pos", F.shiftright("_code", 30).alias("_fp"), around.alias("_around")
    )


def _run(matches: list[Column]) -> Column:
    """How many of the conditions hold before the first that does not."""
    first = reduce(lambda c, x: c.when(~x[1], x[0]), enumerate(matches), F.when(F.lit(False), 0))
    return first.otherwise(len(matches))


def _long_hits(hashes: DataFrame, items: DataFrame, span: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """Hits ``(keys, _start, _stop, _spot)`` and which items each ``_spot`` stands in."""
    window = span - gram + 1
    marks = stored(_fingerprints(items, span, gram).withColumn("_spot", F.xxhash64("_fp", "_around")), "marks")
    spots = marks.select("_spot", "_item").distinct()
    there = marks.groupBy("_spot").agg(F.first("_fp").alias("_fp"), F.first("_around").alias("_there"))
    there = stored(there, "spots")
    if there.count() <= BROADCAST_ROWS:
        there = F.broadcast(there)

    def same(d: int) -> Column:
        at = d + window - 1
        return F.coalesce(F.get("_around", F.lit(at)) == F.get("_there", F.lit(at)), F.lit(False))

    left = _run([same(-d) for d in range(1, window)])
    right = _run([same(gram - 1 + d) for d in range(1, window)])
    core = reduce(lambda a, b: a & b, (same(d) for d in range(gram)))
    rows = _fingerprints(hashes, span, gram)
    hits = rows.join(there, (rows["_fp"] == there["_fp"]) & core & (left + gram + right >= span))
    keys = [c for c in hashes.columns if c != "_h"]
    hits = hits.select(*keys, (F.col("_pos") - left).alias("_start"), (F.col("_pos") + gram + right).alias("_stop"), "_spot")
    return hits, spots


def _short_hits(hashes: DataFrame, items: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """The same for items of exactly ``length`` words, which are one window each."""
    marks = items.where(F.size("_h") == length).withColumn("_spot", F.xxhash64("_h"))
    spots = marks.select("_spot", "_item").distinct()
    there = marks.groupBy("_spot").agg(F.first("_h").alias("_there"))
    grams = F.transform(
        F.slice("_h", F.lit(1), F.greatest(F.lit(0), F.size("_h") - (length - 1))),
        lambda _, i: F.xxhash64(F.slice("_h", i + 1, F.lit(length))),
    )
    keys = [c for c in hashes.columns if c != "_h"]
    rows = hashes.select(*keys, "_h", F.posexplode_outer(grams).alias("_start", "_spot")).where("_spot IS NOT NULL")
    rows = rows.select(*keys, "_start", "_spot", F.slice("_h", F.col("_start") + 1, F.lit(length)).alias("_around"))
    hits = rows.join(there, "_spot").where(F.col("_around") == F.col("_there"))
    return hits.select(*keys, "_start", (F.col("_start") + length).alias("_stop"), "_spot"), spots


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    span: int = SPAN,
    gram: int = GRAM,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted ids as text) and ``contaminated``.

    NULL or empty texts have no words and no hits, and such items hit nothing.  Rows that
    repeat key and text get the same answer; rows that only repeat the key are judged
    apart.  An item without an id makes hits but is not listed.  Columns of ``docs`` named
    like an output are replaced by it.  An empty benchmark leaves every document clean.
    """
    outputs = ("n_words", "n_hit", "n_items", "items", "contaminated")
    docs = docs.drop(*outputs)
    digest = F.xxhash64(whole(text))
    hashes = docs.select(F.col(key).alias("_key"), digest.alias("_text"), hashed_words(text).alias("_h"))
    items = stored(
        benchmark.select(F.col(item_key).cast("string").alias("_item"), hashed_words(item_text).alias("_h")).where("size(_h) > 0"), "items"
    )
    lengths = [r[0] for r in items.where(F.size("_h") < span).select(F.size("_h")).distinct().collect()]  # below span: a few numbers
    parts = [_long_hits(hashes, items.where(F.size("_h") >= span), span, gram)]
    parts += [_short_hits(hashes, items, length) for length in sorted(lengths)]
    hits = stored(reduce(DataFrame.unionByName, (p[0] for p in parts)).distinct(), "hits")
    spots = reduce(DataFrame.unionByName, (p[1] for p in parts))

    before = Window.partitionBy("_key", "_text").orderBy("_start", "_stop").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.col("_start"), F.coalesce(F.max("_stop").over(before), F.lit(0)))
    covered = hits.select("_key", "_text", "_start", "_stop").distinct()
    covered = covered.withColumn("_new", F.greatest(F.lit(0), F.col("_stop") - reached))
    counts = covered.groupBy("_key", "_text").agg(F.sum("_new").cast("long").alias("n_hit"))
    listed = hits.select("_key", "_text", "_spot").distinct().join(spots, "_spot")
    listed = listed.groupBy("_key", "_text").agg(F.array_sort(F.collect_set("_item")).alias("items"))
    found = counts.join(listed, counts["_key"].eqNullSafe(listed["_key"]) & (counts["_text"] == listed["_text"]), "left")
    found = found.select(counts["_key"], counts["_text"], "n_hit", "items")

    base = docs.withColumns({"_own": digest, "n_words": n_words(text, ANY_CASE_WORD)})
    joined = base.join(found, base[key].eqNullSafe(found["_key"]) & (base["_own"] == found["_text"]), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        *(base[f"`{c}`"] for c in docs.columns),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), i AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)
), g AS (
  SELECT doc_id, p, m, array_to_string(w[p:p + m - 1], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM i) WHERE len(w) >= m)
), h AS (SELECT g.doc_id, g.p, g.m, i.item_id FROM g JOIN i USING (m, win)
), c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM h) GROUP BY doc_id
), l AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)
"""
