"""Mixing sources to target weights by Pareto order sampling.

Every document gets an expected number of copies.  Its whole part is certain; the
fraction ``f`` is an inclusion probability, and documents with a fraction are ranked
by their random odds divided by their inclusion odds, ``u/(1-u) / (f/(1-f))``.  Each
source takes documents in that order until the words it still needs are met, so the
sample has a fixed size, in words, and unequal probabilities.

Inclusion grows with a document's length class (bits of its word count): short pages
carry little running text and are repeated less.  Inside a source the factor is raised
until the expected words equal the target, no document above ``limit`` copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import n_words, numbered, unit_interval
from tallyloom.session import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
FINE = 52  # bits of the order key
FIRST, SECOND = 40, 24  # its buckets: the leading 12 bits, then 16 more


def source_targets(sizes: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``(_source, source_size)`` of every source with its ``target`` words.

    Sources by code point, NULL last, take ``weights`` in turn and divide ``share`` of
    all words by them.  No target exceeds ``limit`` times its source; what is left is
    divided again among the others until none does.  The level ``words per weight`` is
    found in rounds of one small aggregate; only two numbers a round reach the driver.
    """
    order = [F.asc("_none"), F.asc("_name")]
    ranked = numbered(sizes.withColumns({"_none": F.col("_source") == "", "_name": F.substring("_source", 2, 2**30)}), order, "_rank")
    cycle = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    weighed = stored(ranked.select("_source", "source_size", cycle.alias("_weight")), "sources")
    most = F.lit(limit) * F.col("source_size")
    level, total = 0.0, weighed.agg(F.sum("source_size")).first()[0] or 0
    while True:
        full = most <= F.col("_weight") * F.lit(level)
        used, free = weighed.agg(
            F.coalesce(F.sum(F.when(full, most)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0))
        ).first()
        if not free or level == (share * total - used) / free:
            break
        level = (share * total - used) / free
    target = F.least(most.cast("double"), F.col("_weight") * F.lit(level))
    return weighed.select("_source", "source_size", target.alias("target"))


def _measured(docs: DataFrame, text: str, source: str, key: str, seed: str) -> DataFrame:
    name = F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    size = n_words(text)
    return docs.withColumns(
        {
            "_source": name,
            "_size": size,
            "_id": F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))),
            "_u": unit_interval(seed, F.col(key)),
        }
    ).withColumn("_class", F.when(F.col("_size") > 0, F.length(F.bin("_size"))).otherwise(0))


def _ordered(measured: DataFrame, plan: DataFrame, limit: int) -> DataFrame:
    """Each row with its certain copies, what is left to chance, and its place in the Pareto order."""
    joined = measured.join(plan, "_source", "left")
    copies = F.when(F.col("_size") == 0, 0.0).otherwise(
        F.coalesce(F.least(F.lit(float(limit)), F.col("_factor") * F.col("_class")), F.lit(float(limit)))
    )
    odds = F.col("_u") / (1 - F.col("_u")) / (F.col("_f") / (1 - F.col("_f")))
    return (
        joined.withColumn("_copies", copies)
        .withColumn("_whole", F.floor("_copies"))
        .withColumn("_f", F.col("_copies") - F.col("_whole"))
        .withColumn("_q", F.when(F.col("_f") > 0, odds))
        .withColumn("_k", F.floor(F.col("_q") / (1 + F.col("_q")) * float(2**FINE)).cast("long"))
    )


def _reach(rows: DataFrame, by: list[str | Column], size: Column, need: str) -> DataFrame:
    """Of each source's groups in order, the one in which the sizes reach ``need``, and what is needed inside it."""
    names = [c for c in by if isinstance(c, str)]
    sums = rows.groupBy("_source", need, *names).agg(F.sum(size).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    window = Window.partitionBy("_source").orderBy(*names)
    running = sums.withColumn("_to", F.sum("_sum").over(window))
    before = F.col("_to") - F.col("_sum")
    return running.where((F.col(need) > before) & (F.col(need) <= F.col("_to"))).select(
        "_source", *names, (F.col(need) - before).alias("_left"), "_rows"
    )


def mix(
    docs: DataFrame,
    share: float = SHARE,
    weights: tuple = WEIGHTS,
    limit: int = LIMIT,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``taken`` (words) and ``copies`` (whole documents).

    The document in which a source's target is reached gives only the words still
    needed; ``copies`` rounds that to the nearer whole number.  Reruns agree: the random
    number is a digest of ``seed`` and the key.

    NULL text has size 0 and is never taken; a NULL source is a source of its own, last
    in order; a NULL key sorts first.  Rows that repeat key and size share the last
    words evenly, rounded down.  No row is dropped; an empty table gives an empty result.
    Columns of ``docs`` named like an output are replaced by it.

    A hot source is never gathered: sums per length class, then per bucket of the order
    key, find the place where its target is reached; only the rows of that last bucket
    (a 2**28th of the source) are put in order.
    """
    spark = docs.sparkSession
    outputs = ("size", "source_size", "target", "taken", "copies")
    docs = docs.drop(*outputs)
    slim = stored(
        _measured(docs.select(text, source, key), text, source, key, seed).select("_source", "_size", "_id", "_u", "_class"),
        "measured",
    )
    classes = stored(slim.groupBy("_source", "_class").agg(F.sum("_size").alias("_words")), "classes")
    totals = classes.groupBy("_source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(totals, share, weights, limit)

    # The factor of each source: classes from the longest down are full until the factor fits.
    longest = Window.partitionBy("_source").orderBy(F.desc("_class"))
    full = F.coalesce(F.sum("_words").over(longest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(F.col("_words") * F.col("_class")).over(longest.rowsBetween(0, Window.unboundedFollowing))
    steps = classes.where("_class > 0").select("_source", "_class", full.alias("_full"), rest.alias("_rest")).join(targets, "_source")
    factor = (F.col("target") - limit * F.col("_full")) / F.col("_rest")
    fits = F.when(factor * F.col("_class") <= limit, F.struct("_class", factor.alias("factor")))
    factors = steps.groupBy("_source").agg(F.max(fits)["factor"].alias("_factor"))
    certain = F.floor(F.least(F.lit(float(limit)), F.coalesce(F.col("_factor") * F.col("_class"), F.lit(float(limit)))))
    need = classes.join(factors, "_source").groupBy("_source").agg(F.sum(F.when(F.col("_class") > 0, certain * F.col("_words"))).alias("_certain"))
    plan = targets.join(factors, "_source", "left").join(need, "_source", "left")
    open_words = F.greatest(F.lit(0), F.floor(F.col("target") + 0.5) - F.coalesce("_certain", F.lit(0))).cast("long")
    plan = stored(plan.select("_source", "source_size", "target", "_factor", open_words.alias("_need")), "plan")

    chance = _ordered(slim, plan, limit).where("_f > 0 and _size > 0")
    chance = chance.withColumns({"_b1": F.shiftright("_k", FIRST), "_b2": F.shiftright("_k", SECOND).bitwiseAND(0xFFFF)})
    size = F.col("_size")
    one = _reach(chance, ["_b1"], size, "_need").select("_source", "_b1", F.col("_left").alias("_need1"))
    inside = chance.join(one, ["_source", "_b1"])
    two = _reach(inside, ["_b2"], size, "_need1").select("_source", "_b2", F.col("_left").alias("_need2"))
    last = inside.join(two, ["_source", "_b2"])
    cut = _reach(last, ["_k", "_id", "_size"], size, "_need2")
    cut = cut.select("_source", F.struct("_k", "_id", "_size").alias("_cut"), F.expr("_left div _rows").alias("_part"))
    plan = stored(plan.join(cut, "_source", "left"), "cut")

    rows = _ordered(_measured(docs, text, source, key, seed), plan, limit)
    place = F.struct("_k", "_id", "_size")
    drawn = (
        F.when((F.col("_size") == 0) | F.col("_k").isNull() | (F.col("_need") == 0), F.lit(0))
        .when(F.col("_cut").isNull() | (place < F.col("_cut")), F.col("_size"))
        .when(place == F.col("_cut"), F.col("_part"))
        .otherwise(F.lit(0))
    )
    rows = rows.withColumn("_drawn", drawn.cast("long"))
    return rows.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_whole") * F.col("_size") + F.col("_drawn")).cast("long").alias("taken"),
        (F.col("_whole") + F.when((F.col("_drawn") > 0) & (2 * F.col("_drawn") >= F.col("_size")), 1).otherwise(0)).cast("int").alias("copies"),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it has copies, with the columns of ``docs``."""
    mixed = mix(docs, **options)
    again = F.explode(F.expr("sequence(1, copies)"))
    return mixed.where("copies > 0").withColumn("_copy", again).select(*(F.col(f"`{c}`") for c in docs.columns))


SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source
), r AS (
  SELECT *, coalesce(sum(2 * source_size) OVER o, 0)::DOUBLE AS used, sum(w) OVER p AS free, sum(source_size) OVER ()::DOUBLE AS total,
    row_number() OVER (ORDER BY 2.0 * source_size / w, source) AS n
  FROM s
  WINDOW o AS (ORDER BY 2.0 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    p AS (ORDER BY 2.0 * source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), l AS (
  SELECT arg_min((1.5 * total - used) / free, n) AS level FROM r WHERE 2 * source_size > w * ((1.5 * total - used) / free)
), t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, w * level) AS target FROM s, l
), c AS (
  SELECT source, length(bin(size)) AS class, sum(size)::BIGINT AS words FROM d WHERE size > 0 GROUP BY ALL
), e AS (
  SELECT c.source, class, words, target, (target - 2 * coalesce(sum(words) OVER a, 0)::DOUBLE) / (sum(words * class) OVER b)::DOUBLE AS factor
  FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
  WINDOW a AS (PARTITION BY c.source ORDER BY class DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    b AS (PARTITION BY c.source ORDER BY class DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), f AS (SELECT source, max_by(factor, class) FILTER (factor * class <= 2) AS factor FROM e GROUP BY source
), g AS (
  SELECT d.doc_id, d.source, d.size, d.u, t.source_size, t.target,
    CASE WHEN size = 0 THEN 0.0::DOUBLE ELSE coalesce(least(2.0::DOUBLE, factor * length(bin(size))), 2.0::DOUBLE) END AS copies
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN f ON d.source IS NOT DISTINCT FROM f.source
), h AS (
  SELECT *, floor(copies) AS certain, copies - floor(copies) AS x,
    CASE WHEN copies > floor(copies) THEN u / (1 - u) / ((copies - floor(copies)) / (1 - (copies - floor(copies)))) END AS q
  FROM g
), k AS (
  SELECT *, floor(q / (1 + q) * 4503599627370496.0)::BIGINT AS k,
    floor(target + 0.5) - sum(certain * size) OVER (PARTITION BY source) AS need
  FROM h
), m AS (
  SELECT *, CASE WHEN q IS NULL THEN 0 ELSE least(size, greatest(0, need - coalesce(sum(CASE WHEN q IS NULL THEN 0 ELSE size END) OVER v, 0))) END AS drawn
  FROM k WINDOW v AS (PARTITION BY source ORDER BY q IS NULL, k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT doc_id, size, source_size, target, (certain * size + drawn)::BIGINT AS taken,
  (certain + CASE WHEN drawn > 0 AND 2 * drawn >= size THEN 1 ELSE 0 END)::INT AS copies
FROM m
"""
