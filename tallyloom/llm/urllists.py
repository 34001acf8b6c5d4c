"""URL filters over dated lists: entries become validity intervals, captures are judged as of their fetch time.

A list entry is dated: a pattern is added or removed on a day.  Per pattern the days in
order give intervals ``[valid_from, valid_to)``, and a capture is blocked if one of the
patterns that cover its URL was valid on the day it was fetched.

Captures are first reduced to the different ``(host, first path part, day)``, so a host
with a third of all captures is judged once per path and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rank of the kinds of pattern: the most exact one that is active names the decision.
KINDS = ("domain", "host", "path")


def host_of(url: Column) -> Column:
    """The lower-case host of a URL; NULL if it has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host != "", host)


def first_part(url: Column) -> Column:
    """The first part of a URL's path, empty if there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals of ``(kind, pattern, listed_on, action)`` with ``action`` ``add`` or ``remove``.

    Several actions on one day: an ``add`` wins.  An added pattern that is added again
    stays valid; a removal without an addition has no effect.  An open interval ends at
    NULL.  Entries with a NULL in any of the columns, or of an unknown kind, are none.
    """
    known = entries.where(F.col("kind").isin(*KINDS)).where("pattern IS NOT NULL AND listed_on IS NOT NULL AND action IN ('add', 'remove')")
    days = known.groupBy("kind", "pattern", "listed_on").agg(F.max(F.col("action") == "add").alias("_on"))
    order = Window.partitionBy("kind", "pattern").orderBy("listed_on")
    changes = days.withColumn("_was", F.lag("_on").over(order)).where("_on != coalesce(_was, false)")
    return changes.withColumn("valid_to", F.lead("listed_on").over(order)).where("_on").select(
        "kind", "pattern", F.col("listed_on").alias("valid_from"), "valid_to"
    )


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "fetched_on") -> DataFrame:
    """``captures`` with ``host``, ``blocked``, ``rule_kind``, ``rule`` and ``rule_from`` as of ``day``.

    Patterns: ``domain`` covers a host and everything below it, ``host`` one host, ``path``
    a host and the first part of its path (``host/part``).  Of several active ones the
    most exact is named: path, host, then the longest domain.  Captures without a host or
    day are never blocked.  Every row is kept, repeated ones too; an empty list blocks
    nothing.  Columns named like an output are replaced.
    """
    outputs = ("host", "blocked", "rule_kind", "rule", "rule_from")
    captures = captures.drop(*outputs).withColumns({"_host": host_of(F.col(url)), "_part": first_part(F.col(url)), "_day": F.col(day)})
    units = captures.where("_host IS NOT NULL AND _day IS NOT NULL").select("_host", "_part", "_day").distinct()
    labels = F.split("_host", r"\.")

    def tail(i):
        return F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern"))

    domains = F.transform(F.when(F.size(labels) > 1, F.sequence(F.lit(1), F.size(labels) - 1)), tail)
    own = F.array(
        F.struct(F.lit("host").alias("kind"), F.col("_host").alias("pattern")),
        F.struct(F.lit("path").alias("kind"), F.concat("_host", F.lit("/"), "_part").alias("pattern")),
    )
    keys = units.withColumn("_key", F.explode(F.when(F.size(labels) > 1, F.concat(own, domains)).otherwise(own)))
    keys = keys.select("_host", "_part", "_day", "_key.kind", "_key.pattern")
    valid = intervals(entries)
    active = keys.join(valid, ["kind", "pattern"]).where((F.col("_day") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("_day") < F.col("valid_to"))))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    best = active.groupBy("_host", "_part", "_day").agg(
        F.max(F.struct(rank.alias("r"), F.length("pattern").alias("n"), "kind", "pattern", "valid_from")).alias("_best")
    )
    return captures.join(best, ["_host", "_part", "_day"], "left").select(
        *(F.col(f"`{c}`") for c in captures.columns if c not in ("_host", "_part", "_day")),
        F.col("_host").alias("host"),
        F.col("_best").isNotNull().alias("blocked"),
        F.col("_best.kind").alias("rule_kind"),
        F.col("_best.pattern").alias("rule"),
        F.col("_best.valid_from").alias("rule_from"),
    )


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day made from their id, spread over a year."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.crc32(F.col("page_id").cast("string")), F.lit(366)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_on"))


def page_entries(pages: DataFrame) -> DataFrame:
    """A dated list made from the pages' own hosts, domains and paths: added, some removed, some added again."""
    host = host_of(F.col("url"))
    path = F.concat(host, F.lit("/"), first_part(F.col("url")))
    domain = F.when(host.contains("."), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1))
    parts = pages.select(
        F.explode(
            F.array(
                F.struct(F.lit("host").alias("kind"), host.alias("pattern"), F.lit(3).alias("every")),
                F.struct(F.lit("domain").alias("kind"), domain.alias("pattern"), F.lit(9).alias("every")),
                F.struct(F.lit("path").alias("kind"), path.alias("pattern"), F.lit(5).alias("every")),
            )
        ).alias("p")
    ).select("p.*")
    listed = parts.where("pattern IS NOT NULL").distinct().withColumn("_c", F.crc32(F.concat("kind", "pattern"))).where("_c % every = 0")
    first = (F.col("_c") % 211).cast("int")
    start = F.lit("2024-01-01").cast("date")

    def event(offset: int, action: str) -> Column:
        return F.struct(F.date_add(start, first + offset).alias("listed_on"), F.lit(action).alias("action"))

    events = (
        F.when(F.col("_c") % 2 == 0, F.array(event(0, "add")))
        .when(F.col("_c") % 7 < 4, F.array(event(0, "add"), event(60, "remove")))
        .otherwise(F.array(event(0, "add"), event(45, "remove"), event(110, "add")))
    )
    return listed.withColumn("_e", F.explode(events)).select("kind", "pattern", "_e.listed_on", "_e.action")


SQL = r"""
WITH p AS (
  SELECT page_id, url, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '') AS host,
    coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1), '') AS part
  FROM pages
), q AS (
  SELECT DISTINCT kind, pattern, every FROM (
    SELECT 'host' AS kind, host AS pattern, 3 AS every FROM p
    UNION ALL SELECT 'domain', CASE WHEN contains(host, '.') THEN regexp_extract(host, '([^.]+\.[^.]+)$', 1) END, 9 FROM p
    UNION ALL SELECT 'path', host || '/' || part, 5 FROM p
  ) WHERE pattern IS NOT NULL
), b AS (
  -- CRC-32 by bit, as the engine has no function for it
  SELECT x, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(0, octet_length(encode(x))::BIGINT), lambda i: ('0x' || substr(hex(encode(x)), 2 * i::INT + 1, 2))::UBIGINT)),
    lambda c, v: list_reduce(list_prepend(xor(c, v), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END)) AS r
  FROM (SELECT kind || pattern AS x FROM q UNION SELECT page_id::VARCHAR FROM p)
), h AS (SELECT x, xor(r, 4294967295::UBIGINT)::BIGINT AS c FROM b
), l AS (SELECT kind, pattern, c, DATE '2024-01-01' + (c % 211)::INT AS d FROM q JOIN h ON x = kind || pattern WHERE c % every = 0
), v AS (
  SELECT kind, pattern, d AS a, CASE WHEN c % 2 = 0 THEN NULL WHEN c % 7 < 4 THEN d + 60 ELSE d + 45 END AS z FROM l
  UNION ALL SELECT kind, pattern, d + 110, NULL FROM l WHERE c % 2 <> 0 AND c % 7 >= 4
), f AS (SELECT p.*, DATE '2024-01-01' + (c % 366)::INT AS t FROM p LEFT JOIN h ON x = page_id::VARCHAR
), m AS (
  SELECT page_id, v.*, CASE kind WHEN 'path' THEN 3 WHEN 'host' THEN 2 ELSE 1 END AS r FROM f JOIN v
  ON t >= a AND (z IS NULL OR t < z) AND CASE kind WHEN 'host' THEN pattern = host WHEN 'path' THEN pattern = host || '/' || part
    ELSE pattern = host OR ends_with(host, '.' || pattern) END
), n AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY r DESC, length(pattern) DESC, pattern DESC) = 1)
SELECT f.page_id, f.host, f.t::VARCHAR AS fetched_on, n.page_id IS NOT NULL AS blocked, n.kind AS rule_kind, n.pattern AS rule, n.a::VARCHAR AS rule_from
FROM f LEFT JOIN n USING (page_id)
"""
