"""Alignment of two tokenizers over a corpus: which tokens of one cover which tokens of the other.

Byte offsets at which tokens of both sides end cut a text into groups.  Most groups are one
token of A and one token of B with the same bytes.  These need no join: an array with an entry per
id of A holds the id of B with its bytes, so such a group is told by its A id alone and
is counted in a vector as long as A's vocabulary.  Only links of the other groups are
counted as pairs of ids, summed in the tasks before they are shuffled.

The texts are encoded once; their ids are stored.  A second pass counts the links, a third looks the
counts up: identical ids in a vector, the ``PLACED`` most frequent other pairs in a sorted array, and the
rest, of which none is frequent, by a join.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from hashlib import sha1
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tallyloom.session import work_path

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
PLACED = 2**17  # frequent pairs sent to every task
AT_ONCE = 1 << 18  # bytes of text, or ids of one side, that a task works on at once
OUTPUTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")

# Fixed values of byte-level BPE: the expression that cuts a text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Letters whose class is the same in every edition of Unicode that a library may be built with.
SETTLED = re.compile(r"[\x00-ԯḀ-⃿←-⯿　-龥가-힣\U0001f300-\U0001faff]*")
LONG_BLANK = re.compile(r"\s{5000}")


# The two sides


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Side(NamedTuple):
    """A tokenizer: ``encode`` gives the ids of each text, ``bytes_of`` the bytes of each id."""

    encode: Callable[[list[str]], list[Sequence[int]]]
    bytes_of: list[bytes]


def byte_bpe(content: bytes) -> Side:
    """The side of a byte-level BPE file; it sees a space before each text.

    Where merging in order of the ids is all that the file says, its vocabulary is run as ranks, which is several
    times faster and gives the same ids; texts with letters beyond ``SETTLED`` or very long blanks keep to the file's own library.
    """
    told = json.loads(content)
    letters = _byte_letters()
    vocabulary = told["model"]["vocab"]
    special = {t["content"]: t["id"] for t in told.get("added_tokens", ())}
    bytes_of = [b""] * (1 + max([*vocabulary.values(), *special.values()]))
    for token, i in vocabulary.items():
        bytes_of[i] = token.encode() if special.get(token) == i else bytes(letters[c] for c in token)

    @lru_cache(maxsize=1)
    def library() -> Tokenizer:
        own = Tokenizer.from_str(content.decode())
        own.encode_special_tokens = True
        return own

    def by_library(texts: list[str]) -> list[Sequence[int]]:
        return [e.ids for e in library().encode_batch([" " + t for t in texts], add_special_tokens=False)]

    merges = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
    made = [vocabulary["".join(m)] for m in merges]
    splitter = told.get("pre_tokenizer") or {}
    plain = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space") and told.get("normalizer") is None
    if not plain or made != sorted(set(made)) or any(i > made[0] for t, i in vocabulary.items() if len(t) == 1):
        return Side(by_library, bytes_of)
    ranks = {bytes_of[i]: i for t, i in vocabulary.items() if special.get(t) != i}
    quick = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[Sequence[int]]:
        return [quick.encode_ordinary(" " + t) if SETTLED.fullmatch(t) and not LONG_BLANK.search(t) else by_library([t])[0] for t in texts]

    return Side(encode, bytes_of)


def piece_bpe(content: bytes) -> Side:
    """The side of a piece model; it adds the space itself."""
    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    bytes_of = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return Side(lambda texts: model.encode(texts, num_threads=1), bytes_of)


_LOADED: dict[bytes, tuple[Side, Side]] = {}  # a worker reads the same two files for every batch


def sides(a_file: bytes, b_file: bytes) -> tuple[Side, Side]:
    """The sides of a byte-level BPE file and a piece model."""
    key = sha1(a_file).digest() + sha1(b_file).digest()
    if key not in _LOADED:
        _LOADED[key] = byte_bpe(a_file), piece_bpe(b_file)
    return _LOADED[key]


class Pair(NamedTuple):
    """Both vocabularies as numbers: the bytes of each id, and per A id the B id with its bytes (-1 without one)."""

    a_bytes: np.ndarray
    b_bytes: np.ndarray
    same: np.ndarray


def numbers(a: Side, b: Side) -> Pair:
    of_bytes = {own: i for i, own in enumerate(b.bytes_of)}  # of equal ones the last: a piece comes after the byte it equals
    same = [of_bytes.get(own, -1) if own else -1 for own in a.bytes_of]
    sizes = [np.array([len(own) for own in side.bytes_of], np.int64) for side in (a, b)]
    return Pair(*sizes, np.array(same, np.int64))


@lru_cache(maxsize=4)
def _id_texts(n: int, end: str) -> np.ndarray:
    """What each id is written as inside and at the end of its part of a group."""
    return np.array([[f"{i},", f"{i}{end}"] for i in range(n)], object)


# Links of many texts at once


class Links(NamedTuple):
    """All links of some texts, one after the other: ids, the text's row, and whether the link is a group of equal bytes."""

    a: np.ndarray
    b: np.ndarray
    row: np.ndarray
    plain: np.ndarray
    closes: np.ndarray  # whether the link is the last of its group
    a_ends: np.ndarray
    b_ends: np.ndarray
    group_ends: np.ndarray


def links(pair: Pair, a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray) -> Links:
    """The links of the ids ``a`` and ``b`` of texts with ``a_sizes`` ids of A each; both sides cover the same bytes."""
    a_ends, b_ends = np.cumsum(pair.a_bytes[a]), np.cumsum(pair.b_bytes[b])
    mark = np.zeros(1 + (a_ends[-1] if len(a) else 0), np.uint8)
    mark[a_ends] = 1
    mark[b_ends] |= 2
    ends = np.flatnonzero(mark)
    kind = mark[ends].astype(np.int64)
    of_a, of_b = np.cumsum(kind & 1) - (kind & 1), np.cumsum(kind >> 1) - (kind >> 1)
    closes = kind == 3
    group = np.cumsum(closes) - closes
    alone = np.bincount(group, minlength=1)[group] == 1
    link_a, link_b = a[of_a], b[of_b]
    row = np.repeat(np.arange(len(a_sizes)), a_sizes)[of_a]
    return Links(link_a, link_b, row, alone & (pair.same[link_a] == link_b), closes, a_ends, b_ends, ends[closes])


def written(pair: Pair, found: Links, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> list[str]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``; ``sizes`` counts the ids of both sides."""
    in_a, in_b = np.searchsorted(found.group_ends, found.a_ends), np.searchsorted(found.group_ends, found.b_ends)
    b_before = np.concatenate([[0], np.searchsorted(found.b_ends, found.group_ends, "right")])
    a_until = np.searchsorted(found.a_ends, found.group_ends, "right")
    words = np.empty(len(a) + len(b), object)
    last_a = (found.group_ends[in_a] == found.a_ends).astype(np.int64) if len(a) else in_a
    last_b = (found.group_ends[in_b] == found.b_ends).astype(np.int64) if len(b) else in_b
    words[np.arange(len(a)) + b_before[in_a]] = _id_texts(len(pair.a_bytes), "|")[a, last_a]
    words[np.arange(len(b)) + (a_until[in_b] if len(b) else 0)] = _id_texts(len(pair.b_bytes), ";")[b, last_b]
    flat, stops = words.tolist(), np.cumsum(sizes).tolist()
    return ["".join(flat[stop - n : stop])[:-1] for stop, n in zip(stops, sizes.tolist(), strict=True)]


def _sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of ``values`` by ascending ``rows``."""
    totals = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    stops = np.searchsorted(rows, np.arange(n + 1))
    return totals[stops[1:]] - totals[stops[:-1]]


# The passes


def _slices(weights: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring rows that weigh about ``AT_ONCE`` together, at least one row each."""
    start = 0
    total = np.concatenate([[0], np.cumsum(weights)])
    while start < len(weights):
        stop = max(start + 1, int(np.searchsorted(total, total[start] + AT_ONCE, "right")) - 1)
        yield start, stop
        start = stop


def _ids(lists: list[Sequence[int]]) -> pa.ListArray:
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    flat = np.concatenate([np.asarray(x, np.int32) for x in lists]) if lists else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(flat))


def _encoded(both: tuple[Side, Side], texts: list[str | None]) -> tuple[list[Sequence[int]], list[Sequence[int]]]:
    """The ids of both sides; none where a side's bytes are not those of a space and the text."""
    plain = [t or "" for t in texts]
    ids = [side.encode(plain) for side in both]
    for i, text in enumerate(plain):
        want = (" " + text).encode()
        if not text or any(b"".join([side.bytes_of[x] for x in own[i]]) != want for side, own in zip(both, ids, strict=True)):
            ids[0][i] = ids[1][i] = ()
    return ids


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
    return column.flatten().to_numpy().astype(np.int64), sizes


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Stored rows in pieces that a task can hold with all their links."""
    for batch in batches:
        sizes = np.diff(batch.column("a_ids").offsets.to_numpy())
        for start, stop in _slices(sizes):
            part = batch.slice(start, stop - start)
            yield part, *_flat(part.column("a_ids")), *_flat(part.column("b_ids"))


def encoded(docs: DataFrame, a: str = BYTE_BPE, b: str = PIECE_BPE, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """The stored ids of all texts: ``at`` (a number of the row), ``own`` (the ``carry`` columns), ``a_ids`` and ``b_ids``."""
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast((Path(a).read_bytes(), Path(b).read_bytes()))
    own = [F.col(f"`{c}`") for c in (docs.columns if carry is None else carry) if c not in OUTPUTS]
    rows = docs.select(
        F.monotonically_increasing_id().alias("at"), F.struct(*own, F.lit(0).alias("_")).alias("own"), F.col(f"`{text}`").cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides(*files.value)
        for batch in batches:
            weights = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
            for start, stop in _slices(weights):
                part = batch.slice(start, stop - start)
                a_ids, b_ids = _encoded(both, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("at"), part.column("own"), _ids(a_ids), _ids(b_ids)], ["at", "own", "a_ids", "b_ids"])

    ids = T.ArrayType(T.IntegerType())
    schema = T.StructType([rows.schema["at"], rows.schema["own"], T.StructField("a_ids", ids), T.StructField("b_ids", ids)])
    path = work_path(spark, "ids")
    rows.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def pair_counts(ids: DataFrame, pair: Pair) -> DataFrame:
    """``(a, b, n, same, best)``: how many links hold each pair of ids, whether their bytes are equal, and whether no A id has more with this B id."""
    sent = ids.sparkSession.sparkContext.broadcast(pair)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = sent.value
        plain = np.zeros(len(pair.same), np.int64)

        def rows(a_ids: np.ndarray, b_ids: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            columns = [a_ids.astype(np.int32), b_ids.astype(np.int32), n, pair.same[a_ids] == b_ids]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "n", "same"])

        for _, a_ids, a_sizes, b_ids, _ in _parts(batches):
            found = links(pair, a_ids, b_ids, a_sizes)
            plain += np.bincount(found.a[found.plain], minlength=len(plain))
            odd, n = np.unique(found.a[~found.plain] * len(pair.b_bytes) + found.b[~found.plain], return_counts=True)
            yield rows(odd // len(pair.b_bytes), odd % len(pair.b_bytes), n)
        used = np.flatnonzero(plain)
        yield rows(used, pair.same[used], plain[used])

    counted = ids.select("a_ids", "b_ids").mapInArrow(run, "a int, b int, n long, same boolean")
    pairs = counted.groupBy("a", "b", "same").agg(F.sum("n").alias("n"))
    # A B id has at most as many pairs as A has ids.
    return pairs.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def _sent(rows: DataFrame) -> list[np.ndarray]:
    frame = rows.toPandas()
    return [frame[c].to_numpy() for c in frame.columns]


def align(
    docs: DataFrame,
    a: str = BYTE_BPE,
    b: str = PIECE_BPE,
    text: str = "text",
    carry: Sequence[str] | None = None,
    show: Callable[[Column], Column] = lambda groups: groups,
    at_most: int = PLACED,
) -> DataFrame:
    """The ``carry`` columns of ``docs`` (by default all) with the alignment of each text under the tokenizer files ``a`` and ``b``.

    ``n_a``, ``n_b``, ``n_groups`` and ``n_links`` count ids, groups and overlapping pairs of
    ids; ``n_best`` the links whose pair no other A id exceeds with their B id over all
    texts, ``count_sum`` how often the pairs of all links occur over all texts.  ``groups``
    writes the groups as ``a1,a2|b1;a3|b2,b3``; ``show`` may reduce it before anything is joined.
    A text that is NULL, empty or not kept byte for byte by a side has no ids: zeros, and '' for ``groups``.
    Every row is kept and counted, repeated ones too.  Columns named like an output are replaced.
    """
    spark = docs.sparkSession
    ids = encoded(docs, a, b, text, carry)
    path = work_path(spark, "pairs")
    pair = numbers(*sides(Path(a).read_bytes(), Path(b).read_bytes()))
    pair_counts(ids, pair).write.parquet(path)
    pairs = spark.read.parquet(path)
    # At most one entry per id of A, and at most ``at_most`` pairs.
    equal = _sent(pairs.where("same").select("a", "n", "best"))
    frequent = pairs.where("NOT same").orderBy(F.desc("n"), "a", "b").limit(at_most).select("a", "b", "n", "best")
    sent = spark.sparkContext.broadcast((pair, equal, _sent(frequent)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, (same_a, same_n, same_best), (odd_a, odd_b, odd_n, odd_best) = sent.value
        wide = len(pair.b_bytes)
        count, best = np.zeros(len(pair.same), np.int64), np.zeros(len(pair.same), bool)
        count[same_a], best[same_a] = same_n, same_best
        order = np.argsort(odd_a.astype(np.int64) * wide + odd_b)
        keys, odd_n, odd_best = (odd_a.astype(np.int64) * wide + odd_b)[order], odd_n[order], odd_best[order].astype(bool)
        for part, a_ids, a_sizes, b_ids, b_sizes in _parts(batches):
            found = links(pair, a_ids, b_ids, a_sizes)
            rows, equal_bytes = part.num_rows, pair.same[found.a] == found.b
            n, is_best = np.where(equal_bytes, count[found.a], 0), equal_bytes & best[found.a]
            odd = np.flatnonzero(~equal_bytes)
            odd_keys = found.a[odd] * wide + found.b[odd]
            place = np.minimum(np.searchsorted(keys, odd_keys), max(len(keys) - 1, 0))
            known = keys[place] == odd_keys if len(keys) else np.zeros(len(odd), bool)
            n[odd[known]], is_best[odd[known]] = odd_n[place[known]], odd_best[place[known]]
            rare = odd[~known]
            (row, key), times = np.unique(np.stack([found.row[rare], odd_keys[~known]]), axis=1, return_counts=True)
            fields = [pa.array(c) for c in ((key // wide).astype(np.int32), (key % wide).astype(np.int32), times.astype(np.int64))]
            starts = pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32))
            figures = [a_sizes, b_sizes, np.bincount(found.row[found.closes], minlength=rows), np.bincount(found.row, minlength=rows)]
            figures += [_sums(is_best, found.row, rows), _sums(n, found.row, rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("at"),
                    part.column("own"),
                    *(pa.array(f.astype(np.int64)) for f in figures),
                    pa.array(written(pair, found, a_ids, b_ids, a_sizes + b_sizes), pa.string()),
                    pa.ListArray.from_arrays(starts, pa.StructArray.from_arrays(fields, ["a", "b", "m"])),
                ],
                ["at", "own", *OUTPUTS, "rare"],
            )

    schema = T.StructType(
        [
            ids.schema["at"],
            ids.schema["own"],
            *(T.StructField(c, T.LongType()) for c in OUTPUTS[:-1]),
            T.StructField("groups", T.StringType()),
            T.StructField("rare", T.ArrayType(T.StructType.fromDDL("a int, b int, m long"))),
        ]
    )
    path = work_path(spark, "aligned")
    shown = F.when(F.col("n_a") == 0, F.lit("")).otherwise(show(F.col("groups")))
    ids.mapInArrow(run, schema).withColumn("groups", shown).write.option("compression", "zstd").parquet(path)
    found = spark.read.parquet(path)
    rare = found.select("at", F.inline("rare")).join(pairs, ["a", "b"]).groupBy("at").agg(
        F.sum(F.col("m") * F.col("n")).alias("more"), F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("more_best")
    )
    own = [c for c in found.schema["own"].dataType.names if c != "_"]
    return found.join(rare, "at", "left").select(
        *(F.col(f"own.`{c}`") for c in own),
        *OUTPUTS[:4],
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"),
        "groups",
    )
