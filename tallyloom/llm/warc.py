"""WARC archives of captures and the merged index over them.

``archive`` writes one record per capture.  Captures with equal payloads are stored once: the
one with the largest key is the response, the others are revisits that refer to it.  Spark's
text writer makes the files: a record is one value, and the line separator is the empty
line that ends a record.

``records`` reads them back.  Each record begins with the same two header lines, the second of which
names the archive by a random number that no payload can hold by chance.  These lines are
the separator of the reading side, so Spark streams the records without holding a file.

``histories`` is the external index merge.  Every reading task writes the index entries of
its records as a run sorted by URL key, time and page.  Ranges of the key space are then
merged, each by a loser tree over the sorted pieces that the runs have in it, which gives
one global order.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import stored, work_path

VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REFERRED = 10_000  # digests so frequent that their rows are joined by broadcast: at most this many exist
PER_RANGE = 200_000  # index entries one merging task holds
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
ORDER = ("url_key", "captured", "page_id", "run", "entry")


def _mark(path: str) -> str:
    return f"{VERSION}\r\nWARC-Warcinfo-ID: <urn:uuid:{path.rstrip('/').rsplit('/', 1)[-1]}>\r\n"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a text's UTF-8 bytes in base 32: 40 hex digits in four parts of ten, eight letters each."""
    digest = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), _DIGITS, BASE32)


def url_key(url: Column) -> Column:
    """The sort key of a URL: host labels from last to first, then path and query; empty without a host."""
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]*)[^/?#]*([^#]*)"
    host = F.lower(F.regexp_extract(url, pattern, 1))
    rest = F.regexp_extract(url, pattern, 2)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", "/").otherwise(rest))
    return F.coalesce(F.when(host != "", key), F.lit(""))


def made_time(key: Column) -> Column:
    """A capture time made from a page's key, for tables without one: spread over a year."""
    seconds = F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(366 * 86400))
    return F.timestamp_seconds(F.lit(1704067200) + seconds)


def _decided(captures: DataFrame, least: int) -> DataFrame:
    """``captures`` with ``_of``, the largest key among equal payloads of at least ``least`` bytes where another row has it.

    Digests that occur more than once are joined by a shuffle.  Those with more than a
    ``REFERRED``-th of all rows would make one task hot; they are at most ``REFERRED`` many and
    are broadcast, and their rows go through the shuffle under keys of their own.
    """
    same = ["_digest", "_bytes"]
    counted = captures.where(F.col("_bytes") >= least).groupBy(*same).agg(F.count(F.lit(1)).alias("_n"), F.max("_key").alias("_of"))
    repeated = stored(counted.where("_n > 1"), "repeated")
    frequent = F.col("_n") > max(1000, captures.count() // REFERRED)
    hot = repeated.where(frequent).select(*same, F.col("_of").alias("_hot"), F.lit(True).alias("_is_hot"))
    cold = repeated.where(~frequent).select(F.col("_digest").alias("_join"), "_bytes", "_of")
    spread = F.when(F.col("_is_hot"), F.concat(F.lit("~"), F.coalesce(F.col("_key").cast("string"), F.lit("")))).otherwise(F.col("_digest"))
    marked = captures.join(F.broadcast(hot), same, "left").withColumn("_join", spread)
    return marked.join(cold, ["_join", "_bytes"], "left").withColumn("_of", F.coalesce("_hot", "_of"))


def archive(
    captures: DataFrame,
    path: str | None = None,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    captured: Column | None = None,
    least: int = 0,
    compression: str = "gzip",
) -> str:
    """Write a WARC record per row of ``captures`` and return the archive's folder, a new one under ``path`` (by default the work folder).

    ``key`` is an integer, ``captured`` a timestamp (made from the key if not given).  A
    NULL payload is empty, a NULL key is smaller than any other and a NULL URL has no header line.  Payloads
    shorter than ``least`` bytes are responses all.  A row repeated with the response's key is
    a response again.  Line breaks in a URL are written as %0D and %0A.  An empty table
    makes an archive without records.
    """
    folder = f"{(path or work_path(captures.sparkSession, 'warc')).rstrip('/')}/{uuid.uuid4()}"
    text = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    rows = captures.select(
        F.col(f"`{key}`").cast("long").alias("_key"),
        F.col(f"`{url}`").cast("string").alias("_url"),
        text.alias("_payload"),
        (made_time(F.col(f"`{key}`")) if captured is None else captured).alias("_time"),
        base32_sha1(text).alias("_digest"),
        F.octet_length(text).cast("long").alias("_bytes"),
    )
    revisit = F.col("_of").isNotNull() & ~F.col("_of").eqNullSafe(F.col("_key"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("_bytes").cast("string"), F.lit(END)
    )
    block = F.when(revisit, head).otherwise(F.concat(head, "_payload"))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    def record_id(of: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(of.cast("string"), F.lit("")), F.lit(">"))

    target = F.replace(F.replace("_url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    record = F.concat(
        F.lit(_mark(folder)),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("_key"))),
        line("WARC-Date", F.date_format("_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", target),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "_digest")),
        line("WARC-Refers-To", F.when(revisit, record_id(F.col("_of")))),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    _decided(rows, least).select(record.alias("value")).write.option("lineSep", END).option("compression", compression).text(folder)
    return folder


def records(spark: SparkSession, folder: str) -> DataFrame:
    """The records of an archive: header values, the ``payload`` (NULL in a revisit), ``archive`` (the file) and ``whole``.

    ``payload_bytes`` and ``payload_digest`` are worked out from a response's payload and taken from a
    revisit's headers.  ``whole`` tells that the block has its declared length and the payload its declared digest.
    """
    def after(column: str) -> Column:
        """The place of the first letter after a header's empty line."""
        return F.instr(column, F.lit(END)) + 4

    lines = spark.read.option("lineSep", _mark(folder)).text(folder).where("value != ''")
    split = lines.select(
        F.substring_index("value", END, 1).alias("head"),
        F.substring("value", after("value"), F.length("value") - after("value") - 3).alias("block"),
        F.col("_metadata.file_name").alias("archive"),
    )

    def header(name: str) -> Column:
        value = F.regexp_extract("head", rf"(?m)^{name}: ([^\r\n]*)", 1)
        return F.when(value != "", value)

    def page(name: str) -> Column:
        return F.regexp_extract(header(name), r"^<urn:page:(-?[0-9]*)>$", 1).try_cast("long")

    revisit = header("WARC-Type") == "revisit"
    declared = F.regexp_replace(header("WARC-Payload-Digest"), "^sha1:", "")
    payload = F.when(~revisit, F.substring("block", after("block"), F.length("block")))
    parsed = split.select(
        page("WARC-Record-ID").alias("page_id"),
        header("WARC-Type").alias("record_type"),
        header("WARC-Target-URI").alias("url"),
        F.to_timestamp(header("WARC-Date"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
        page("WARC-Refers-To").alias("refers_to"),
        payload.alias("payload"),
        F.regexp_extract("block", r"(?m)^Content-Length: ([0-9]+)", 1).cast("long").alias("told_bytes"),
        declared.alias("told_digest"),
        (F.octet_length("block") == header("Content-Length").cast("long")).alias("framed"),
        "archive",
    ).withColumn("own_digest", base32_sha1(F.col("payload")))
    return parsed.select(
        "page_id",
        "record_type",
        "url",
        "captured",
        F.coalesce(F.octet_length("payload").cast("long"), "told_bytes").alias("payload_bytes"),
        F.coalesce("own_digest", "told_digest").alias("payload_digest"),
        "refers_to",
        "payload",
        "archive",
        (F.col("framed") & F.coalesce(F.col("own_digest") == F.col("told_digest"), F.lit(True))).alias("whole"),
    )


# The index


def loser_tree(runs: Sequence[Sequence]) -> Iterator[int]:
    """The numbers of the runs (lists in ascending order) in the order in which a merge takes their next elements.

    A tree node keeps the loser of its match, so the run that gave the last element plays
    only the matches on its way up.  Equal elements go by the run's number.
    """
    k = len(runs)
    at = [0] * k
    heads = [run[0] if len(run) else None for run in runs]

    def beats(a: int, b: int) -> bool:
        if heads[a] is None or heads[b] is None:
            return heads[b] is None and (heads[a] is not None or a < b)
        return (heads[a], a) < (heads[b], b)

    losers = [0] * k
    winners = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    first = winners[1] if k > 1 else 0
    while k and heads[first] is not None:
        yield first
        at[first] += 1
        heads[first] = runs[first][at[first]] if at[first] < len(runs[first]) else None
        node = (first + k) // 2
        while node:
            if beats(losers[node], first):
                losers[node], first = first, losers[node]
            node //= 2


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range: the rows of its sorted pieces, which arrive one after the other, in one order."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    url, time, page, run, entry = (table[c].to_pylist() for c in ORDER)
    keys = [(u, t is not None, t, p is not None, p, r, e) for u, t, p, r, e in zip(url, time, page, run, entry, strict=True)]
    starts = [0, *(i for i in range(1, len(keys)) if keys[i] < keys[i - 1] or run[i] != run[i - 1]), len(keys)]
    pieces = [range(a, b) for a, b in zip(starts, starts[1:], strict=False)]
    heads = [0] * len(pieces)
    order = []
    for piece in loser_tree([keys[p.start : p.stop] for p in pieces]):
        order.append(pieces[piece].start + heads[piece])
        heads[piece] += 1
    merged = table.take(pa.array(order, pa.int64()))
    yield from merged.append_column("inside", pa.array(range(len(order)), pa.int64())).to_batches(max_chunksize=10_000)


def histories(found: DataFrame, per_range: int = PER_RANGE) -> DataFrame:
    """Index entries of ``records``, without payloads, with their ``place`` in the order of URL key, time and page.

    ``run`` names the sorted run an entry came from and ``entry`` its number.  Entries alike in URL key, time and page, as of
    repeated rows, are split between ranges like any others.  NULL pages come first among equal URLs and times.
    """
    entries = found.drop("payload").withColumn("url_key", url_key(F.col("url")))
    local = entries.sortWithinPartitions("url_key", "captured", "page_id")
    runs = stored(local.withColumns({"run": F.spark_partition_id(), "entry": F.monotonically_increasing_id()}), "runs")
    ranges = max(1, -(-runs.count() // per_range), int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in runs.schema)
    merged = runs.repartitionByRange(ranges, *ORDER).mapInArrow(_merge, f"{schema}, inside long")
    ordered = stored(merged.withColumn("range", F.spark_partition_id()), "index")
    counts = ordered.groupBy("range").agg(F.count(F.lit(1)).alias("here"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("range", F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("before"))
    return ordered.join(offsets, "range").withColumn("place", F.col("before") + F.col("inside")).drop("range", "before", "inside")


SQL = r"""
WITH p AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages
), q AS (
  SELECT *, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(h, 5 * (i // 4)::INT + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), 'string_agg', '') AS digest,
    nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]*)', 1)), '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1) AS rest,
    -- CRC-32 by bit, as the engine has no function for it
    list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(0, length(page_id::VARCHAR)), lambda i: ascii(substr(page_id::VARCHAR, i::INT + 1, 1))::UBIGINT)),
      lambda c, v: list_reduce(list_prepend(xor(c, v), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END)) AS crc
  FROM p
), r AS (
  SELECT *, coalesce(array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE rest WHEN '' THEN '/' ELSE rest END, '') AS url_key,
    xor(crc, 4294967295::UBIGINT) % (366 * 86400) AS moment FROM q
)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to, true AS whole, url_key, row_number() OVER (ORDER BY encode(url_key), moment, page_id) - 1 AS place
FROM r
"""
