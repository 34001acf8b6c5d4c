"""Repeated passages: seeds from winnowing, extension by contexts, maximal repeats over a length.

A window is ``span`` consecutive words; a window is a repeat if the same words start
earlier (smaller id, or earlier in the document).  Of each window's grams the one with
the smallest hash is its anchor, so equal windows have equal anchors, and the windows of
one anchor form a *context*: the words from the first to the last of them.

1. Seed: grams that occur once are dropped; the other anchors are grouped by gram and context.  All but the first of a group are
   repeats in every one of their windows, however many copies there are; groups are
   reduced in the map tasks, so no task gathers a hot one.
2. Extend: grams with several contexts match over a part of them only.  One occurrence
   of each such context is extended to its windows, and each window is compared with the
   first one of the same words.
3. The marked windows of a document run together to maximal repeats.

The texts cross the network once, by document (a hash of key and text), and serve steps 2 and 3.  An anchor's
place is one number: a tag of the text, its first window and how many windows it has.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import whole
from tallyloom.session import stored

SPAN = 20
GRAM = 5
GRAM_BITS = (1 << 48) - 1
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of the rolling hashes
_FACTORS = np.array([pow(0x9FB21C651E98DF25, j + 1, 1 << 64) for j in range(64)], dtype=np.uint64)
COUNT_BITS, TAG_SHIFT = 6, 47  # of a place: windows of the anchor below, tag of the text above
PIECE = 1 << 18  # bytes of text that are hashed at a time
LONG_WORD = 64  # bytes; longer words are hashed one by one
_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_LENGTHS = np.random.default_rng(9).integers(1 << 63, size=LONG_WORD + 1, dtype=np.uint64)  # what a word's hash begins with
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_ANCHORS = "id long, doc long, place long, gram long, context long"
_WINDOWS = "one long, two long, id long, doc long, place long, bit int"
_RESULT = "n_words long, n_removed long, repeats array<struct<start:long,stop:long>>, kept string"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all ``texts`` in one array, the place where each text begins in it, and its length.

    Words are hashed side by side, eight bytes at a time.
    """
    joined = b"\n".join([b"", *texts, b" " * 8])
    data = np.frombuffer(joined, np.uint8)
    blank = _BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    begin, size = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(data) - 7, "<u8", joined, strides=(1,))  # the bytes from each place on
    hashes = _mix(_LENGTHS[np.minimum(size, LONG_WORD)] ^ (eight[begin] & _FIRST_BYTES[np.minimum(size, 8)]))
    more, done = np.flatnonzero((size > 8) & (size <= LONG_WORD)), 8
    while len(more):
        hashes[more] = _mix(hashes[more] ^ (eight[begin[more] + done] & _FIRST_BYTES[np.minimum(size[more] - done, 8)]))
        done += 8
        more = more[size[more] > done]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(joined[begin[i] : begin[i] + size[i]])
    starts = np.cumsum([1] + [len(t) + 1 for t in texts])
    return hashes, np.searchsorted(begin, starts)


def run_hashes(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hashes of the runs ``[begin, end)`` that depend on their words only, not on their place."""
    n = len(hashes)
    up = np.full(n + 1, base, np.uint64)
    down = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * down[:n], out=sums[1:])
    return _mix((sums[end] - sums[begin]) * up[begin])


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the first smallest of each ``width`` consecutive values."""
    place, held = np.arange(len(values)), 1
    while held < width:
        step = min(held, width - held)
        right = values[step:] < values[:-step]
        place = np.where(right, place[step:], place[:-step])
        values = np.where(right, values[step:], values[:-step])
        held += step
    return place


def anchors(hashes: np.ndarray, begins: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """Per anchor: its text, its first window there, how many windows it has, and the hashes of its gram and context."""
    n = len(hashes)
    if n < span:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    grams = np.zeros(n - gram + 1, np.uint64)
    for j in range(gram):
        grams += hashes[j : n - gram + 1 + j] * _FACTORS[j]
    grams = _mix(grams)
    text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    whole_windows = np.flatnonzero(text[: n - span + 1] == text[span - 1 :])  # the others run from one text into the next
    place = least_places(grams, span - gram + 1)[whole_windows]
    change = np.flatnonzero(np.diff(place, prepend=-1))
    first, count = whole_windows[change], np.diff(np.append(change, len(place)))
    context = run_hashes(hashes, first, first + count - 1 + span, _BASES[0])
    of = text[first]
    return of, first - begins[of], count, grams[place[change]] & np.uint64(GRAM_BITS), _mix(context + count.astype(np.uint64))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Some rows at a time, by the bytes of their texts, with these texts."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64) + 64
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // PIECE)) + 1
        for low, high in itertools.pairwise([0, *cuts.tolist(), len(sizes)]):
            part = batch.slice(low, high - low)
            yield part, part.column("text").cast(pa.binary()).to_pylist()


def _find_anchors(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _pieces(batches):
            of, at, n, grams, context = anchors(*word_hashes(texts), span, gram)
            key, doc, tag = (part.column(c).to_numpy()[of] for c in ("id", "doc", "tag"))
            place = (tag.astype(np.int64) << TAG_SHIFT) | (at << COUNT_BITS) | n
            columns = {"id": key, "doc": doc, "place": place, "gram": grams.view(np.int64), "context": context.view(np.int64)}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _at(place):
    return (place >> COUNT_BITS) & ((1 << (TAG_SHIFT - COUNT_BITS)) - 1)


def _find_windows(span: int):
    """The windows of the chosen anchors (``bit``: which of the anchor's) with two independent hashes of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _pieces(batches):
            hashes, begins = word_hashes(texts)
            place = part.column("place").flatten().to_numpy()
            of = np.repeat(np.arange(len(texts)), part.column("place").value_lengths().to_numpy())
            n = place & ((1 << COUNT_BITS) - 1)
            seed = np.repeat(np.arange(len(n)), n)
            bit = np.arange(len(seed)) - (np.cumsum(n) - n)[seed]
            begin = begins[of[seed]] + _at(place)[seed] + bit
            one, two = (run_hashes(hashes, begin, begin + span, base).view(np.int64) for base in _BASES)
            key, doc = (part.column(c).to_numpy()[of[seed]] for c in ("id", "doc"))
            yield pa.RecordBatch.from_pydict({"one": one, "two": two, "id": key, "doc": doc, "place": place[seed], "bit": bit.astype(np.int32)})

    return run


def cut(text: str, places: np.ndarray, masks: np.ndarray, span: int) -> tuple[int, int, list[tuple[int, int]], str]:
    """Words, removed words, maximal repeats and kept text, given the anchors' places and their marked windows."""
    words = text.encode().split()
    if not len(places):
        return len(words), 0, [], b" ".join(words).decode()
    row, bit = np.nonzero((np.asarray(masks, np.int64)[:, None] >> np.arange(1 << COUNT_BITS)[None, : span + 1]) & 1)
    starts = _at(np.asarray(places, np.int64))[row] + bit
    edge = np.bincount(starts, minlength=len(words) + 1) - np.bincount(starts + span, minlength=len(words) + 1)
    removed = np.cumsum(edge[: len(words)]) > 0
    steps = np.diff(np.concatenate(([0], removed.astype(np.int8), [0])))
    repeats = list(zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist(), strict=True))
    kept, at = [], 0
    for start, stop in repeats:
        kept += words[at:start]
        at = stop
    return len(words), int(removed.sum()), repeats, b" ".join(kept + words[at:]).decode()


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every row's ``key`` with ``n_words``, ``n_removed``, ``repeats`` (word places, end exclusive) and ``kept`` text.

    A text is its words between ASCII white space; NULL has none, and texts shorter than
    ``span`` words have no window.  Documents are ordered by ``key``, NULL first.  Rows
    that repeat key and text are one document and get the same answer; rows with one key
    and different texts are versions of one document, each for itself, ordered by a checksum of the text.
    No row is dropped and other columns are not read.
    """
    if span - gram + 1 >= 1 << COUNT_BITS:
        raise ValueError("at most 62 grams in a window")
    least = -(2**63)
    keyed = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(least)).alias("id"), whole(text).alias("text"))
    # One number a document: of its key and text.  The checksum only orders the versions of a key.
    keyed = keyed.select("id", "text", F.crc32("text").bitwiseAND(0xFFFF).alias("tag"), F.xxhash64("id", "text").alias("doc"))
    found = keyed.mapInArrow(_find_anchors(span, gram), _ANCHORS)
    repeated = stored(found.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("gram"), "grams")
    seeds = stored(found.join(repeated, "gram"), "seeds")

    # A document's windows are ordered by key, by checksum of the text, by document and by place.
    order = ("id", F.shiftrightunsigned("place", TAG_SHIFT).alias("tag"), "doc", "place")
    groups = seeds.groupBy("gram", "context").agg(F.min(F.struct(*order)).alias("first"), F.count(F.lit(1)).alias("times"))
    groups = stored(groups.select("gram", "context", "first.*", "times"), "groups")
    # Grams with several contexts: extend one occurrence of each to its windows.
    several = groups.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1").select("gram")
    extended = groups.join(several, "gram").groupBy("doc").agg(F.collect_list("place").alias("place"))
    spread = keyed.repartition("doc")
    windows = spread.join(extended, "doc").select("id", "doc", "text", "place").mapInArrow(_find_windows(span), _WINDOWS)
    start = F.col("place").bitwiseAND(-(1 << COUNT_BITS)) + F.shiftleft(F.col("bit").cast("long"), COUNT_BITS)
    window = F.struct(*order[:-1], start.alias("place"))
    earliest = windows.groupBy("one", "two").agg(F.min(window).alias("first"))
    late = windows.join(earliest, ["one", "two"]).where(window != F.col("first")).select("doc", "place", F.expr("shiftleft(1L, bit)").alias("marks"))

    repeats = groups.where("times > 1").select("gram", "context", F.col("doc").alias("_doc"), F.col("place").alias("_place"))
    is_first = (F.col("doc") == F.col("_doc")) & (F.col("place") == F.col("_place"))
    every = F.expr(f"shiftleft(1L, CAST(place & {(1 << COUNT_BITS) - 1} AS INT))") - 1
    marked = seeds.join(repeats, ["gram", "context"]).where(~is_first).select("doc", "place", every.alias("marks"))
    marked = marked.unionByName(late).repartition("doc").groupBy("doc", "place").agg(F.bit_or("marks").alias("marks"))
    marked = marked.groupBy("doc").agg(F.collect_list(F.struct("place", "marks")).alias("marked"))

    @F.pandas_udf(_RESULT)
    def result(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, places, masks in batches:
            rows = [cut(t, p, m, span) for t, p, m in zip(texts, places, masks, strict=True)]
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "repeats", "kept"])

    none = F.array().cast("array<struct<place:long,marks:long>>")
    joined = spread.join(marked, "doc", "left").withColumn("_own", F.coalesce("marked", none))
    cutting = joined.select(F.nullif("id", F.lit(least)).alias(key), result("text", F.col("_own.place"), F.col("_own.marks")).alias("_r"))
    return cutting.select(key, "_r.*")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, p, hash(win) AS h, md5(win) AS win FROM (
    SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20))
), r AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY h, win ORDER BY doc_id, p) AS n FROM g) WHERE n > 1
), c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM r
), k AS (SELECT doc_id, list(q) AS gone FROM c GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(coalesce(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE x.kept END, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN (
  SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.q) AS kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d WHERE doc_id IN (SELECT doc_id FROM k)) u
  ANTI JOIN c ON u.doc_id = c.doc_id AND u.q = c.q GROUP BY u.doc_id
) x USING (doc_id)
"""
