"""A hashed maximum-entropy language model with class-factored softmax.

The probability of a word is that of its class after the two words before it, times that
of its part of the class after the word before, times that of the word in its part.  Words
fall into groups by the frequent words that they follow (k-means over the most frequent
words; the others by their endings), a group's words, most frequent first, are cut into
classes of equal mass, and a class's words into parts in the same way, so that frequent
words are a part of their own.  Words outside the ``HEAD`` most frequent are one class per
group, inside which their own smoothed counts, and one share for unseen words, apply.

The class is a softmax over hashed features of the context: the word before (bigram),
the word before that (skip) and both (trigram), besides a bias.  The part is a softmax of
its class over the word before, whose buckets grow with the training text up to ``INNER``.
What the corpus says about contexts is a table of counts, gathered by all tasks.  The
weights of classes are fitted by gradient steps that tasks compute on their part of the
table and the driver adds up; those of parts by steps of one task per class, as classes do
not share them.  The head's words and the weights have a bounded size and travel to every
task; the counts of the other words are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import whole
from tallyloom.session import stored

HEAD = 1 << 18  # the most words that are sent to every task
CLASSES = 64  # the last GROUPS of them are those of the words outside the head
GROUPS = 6
PER_GROUP = (CLASSES - GROUPS) // GROUPS
NEIGHBOURS, PLACED = 32, 1 << 14  # words grouped by their neighbours, and the neighbours that count
PARTS = 64  # parts of a class
INNER = 1 << 12  # the most buckets of the word before, for the parts
PER_BUCKET = 1 << 17  # training tokens for each such bucket
OWN = 63  # so many words have a context bucket of their own, the others that of their class
BEFORE = OWN + CLASSES + 1  # buckets of the word before; the last is the text's begin
SKIP = CLASSES + 1
PAIRS = 1 << 12  # hashed trigram features
ALPHA = 0.1
STEPS, RATE, RIDGE, PART_RIDGE, MOST = 12, 0.3, 5.0, 20.0, 1.0
FLUSH = 300_000  # rows that a task passes on at a time
PIECE = 1 << 21  # characters whose words a task holds at a time; a longer text is a piece of its own
END = b""  # no word is empty
_STEP = 1.1  # width of the frequency bins that find the head


def held_out(key: str, folds: int = 10) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == 0, F.lit(False))


@dataclass
class Tokens:
    """The words of a batch of texts, one after the other; a text is its words and one end."""

    words: pa.Array
    text: np.ndarray  # the text of each word
    count: int  # texts

    @classmethod
    def of(cls, texts: pd.Series) -> Tokens:
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string(), from_pandas=True)))
        words, offsets = lists.flatten().cast(pa.large_binary()), lists.offsets.to_numpy()
        text = np.repeat(np.arange(len(texts)), np.diff(offsets))
        kept = pc.greater(pc.binary_length(words), 0)
        return cls(words.filter(kept), text[kept.to_numpy(zero_copy_only=False)], len(texts))

    def found(self, head: pa.Array, other: int) -> np.ndarray:
        """The place of each word in ``head``, or ``other``."""
        return pc.fill_null(pc.index_in(self.words, value_set=head), other).to_numpy(zero_copy_only=False).astype(np.int64)

    def with_ends(self, ids: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words with an end after each text, and where each text starts."""
        out = np.full(len(ids) + self.count, end, np.int64)
        out[np.arange(len(ids)) + self.text] = ids
        starts = np.arange(self.count)
        starts[1:] += np.cumsum(np.bincount(self.text, minlength=self.count))[:-1]
        return out, starts


def pieces(texts: pd.Series) -> Iterator[pd.Series]:
    """The texts of a batch in order, a bounded number of characters at a time."""
    sizes = texts.str.len().to_numpy(np.int64)
    piece = (np.cumsum(sizes) - sizes) // PIECE
    for one in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(piece)) + 1):
        if len(one):
            yield texts.iloc[one[0] : one[-1] + 1]
    pa.default_memory_pool().release_unused()


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)`` over all of ``text``; words as binary."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen = [pa.table({"word": _array([END]), "n": pa.array([len(frame)], pa.int64())})]
            for piece in pieces(frame["text"]):
                found = pc.value_counts(Tokens.of(piece).words)
                seen.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
            merged = pa.concat_tables(seen).group_by("word").aggregate([("n", "sum")])
            for some in merged.to_batches(max_chunksize=FLUSH):
                yield pd.DataFrame({"word": some["word"].to_pylist(), "n": some["n_sum"].to_numpy()})

    return docs.select(whole("text").alias("text")).mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _head_limit(counts: DataFrame, head: int) -> int:
    """The count from which on at most ``head`` words are left; found in a few hundred frequency bins."""
    bins = counts.groupBy(F.floor(F.log("n") / float(np.log(_STEP))).alias("b")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least"))
    limit, total = None, 0
    for r in sorted(bins.collect(), key=lambda r: -r["b"]):
        total += r["words"]
        if total > head:
            break
        limit = r["least"]
    return limit if limit is not None else 1 << 62


def _array(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.large_binary())


def neighbour_counts(docs: DataFrame, shared) -> DataFrame:
    """``(at, n)``: how often each of the PLACED first words follows each of the NEIGHBOURS first; ``at`` joins both."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(PLACED * NEIGHBOURS, np.int64)
        head, end = _array(shared.value), _place(shared.value, PLACED)
        for piece in (piece for frame in frames for piece in pieces(frame["text"])):
            toks = Tokens.of(piece)
            ids, starts = toks.with_ends(toks.found(head, PLACED), end)
            before = np.append(PLACED, ids[:-1])
            before[starts] = PLACED
            pair = (before < NEIGHBOURS) & (ids < PLACED)
            total += np.bincount(ids[pair] * NEIGHBOURS + before[pair], minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "n": total[at]})

    counted = docs.select(whole("text").alias("text")).mapInPandas(count, "at long, n long")
    return counted.groupBy("at").agg(F.sum("n").alias("n"))


def _place(words: list[bytes], other: int) -> int:
    """The place of the end among words, or ``other``."""
    return words.index(END) if END in words else other


def grouped(followed: np.ndarray) -> np.ndarray:
    """The group of each word by k-means over the shares of its neighbours; -1 for words seen after too few."""
    total = followed.sum(axis=1)
    out = np.full(len(followed), -1, np.int64)
    used = np.flatnonzero(total >= 20)
    if not len(used):
        return out
    x = np.sqrt(followed[used] / total[used, None])
    first = x[: min(len(x), 256)]
    centres = first[:1]
    while len(centres) < min(GROUPS, len(first)):  # each next start is farthest from those before
        centres = np.vstack((centres, first[(first @ centres.T).max(axis=1).argmin()]))
    for _ in range(20):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.stack([(x[own == g] * total[used][own == g, None]).sum(axis=0) for g in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    out[used] = own
    return out


@dataclass
class Endings:
    """Sorts words into groups by their first, inner or last three bytes, whichever tells the group best."""

    first: dict[bytes, tuple[float, int]]
    inner: dict[bytes, tuple[float, int]]
    last: dict[bytes, tuple[float, int]]
    most: tuple[float, int]

    @classmethod
    def of(cls, words: list[bytes], groups: np.ndarray) -> Endings:
        seen: tuple[dict[bytes, np.ndarray], ...] = ({}, {}, {})
        total = np.zeros(GROUPS, np.int64)
        for word, group in zip(words, groups.tolist(), strict=False):
            if group >= 0:
                total[group] += 1
                for own, piece in zip(seen, (word[:3], word[2:5], word[-3:]), strict=True):
                    own.setdefault(piece, np.zeros(GROUPS, np.int64))[group] += 1
        sure = [{piece: ((n.max() + 0.5) / (n.sum() + GROUPS / 2), int(n.argmax())) for piece, n in own.items()} for own in seen]
        return cls(*sure, (0.0, int(total.argmax())))

    def group(self, word: bytes) -> int:
        most = self.most
        return max(self.first.get(word[:3], most), self.inner.get(word[2:5], most), self.last.get(word[-3:], most))[1]


@dataclass
class Vocabulary:
    """The head: words by falling count, their classes and parts, and what a word has in its class and in its part."""

    words: list[bytes]
    counts: np.ndarray
    endings: Endings
    classes: np.ndarray
    in_class: np.ndarray
    parts: np.ndarray
    in_part: np.ndarray
    base: np.ndarray
    buckets: int

    def __post_init__(self):
        half, ids = self.buckets // 2, np.arange(len(self.classes))
        self.outer_before = np.where(ids < OWN, ids, OWN + self.classes)
        self.inner_before = np.where(ids < half, ids, half + mixed(ids) % (half - 1))
        self.end = _place(self.words, len(self.words) + self.endings.group(END))

    def read(self, toks: Tokens, head: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of tokens, those of the head or one for each group of other words, and where each text starts."""
        size = len(self.words)
        ids = toks.found(head, size)
        other = np.flatnonzero(ids == size)
        rest = toks.words.take(pa.array(other)).dictionary_encode()
        groups = np.fromiter(map(self.endings.group, rest.dictionary.to_pylist()), np.int64, len(rest.dictionary))
        ids[other] += groups[rest.indices.to_numpy()]
        return toks.with_ends(ids, self.end)

    def contexts(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The context number of each place: bucket of the word before and class of the one before that."""
        before, skip = np.append(0, self.outer_before[ids[:-1]]), np.append([0, 0], self.classes[ids[:-2]])[: len(ids)]
        before[starts] = BEFORE - 1
        skip[starts] = SKIP - 1
        skip[np.minimum(starts + 1, len(ids) - 1)] = SKIP - 1  # the end of an empty text is its start
        return before * SKIP + skip

    def inner_contexts(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each place its class and the bucket of the word before: frequent words have one alone, a text's begin the last."""
        before = np.append(0, self.inner_before[ids[:-1]])
        before[starts] = self.buckets - 1
        return self.classes[ids] * self.buckets + before


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.int64)


def buckets(n_all: int) -> int:
    """Buckets of the word before: a power of two, one for each PER_BUCKET training tokens."""
    return min(INNER, max(64, 1 << max(0, n_all // PER_BUCKET).bit_length()))


def cut(counts: np.ndarray, pieces: int) -> np.ndarray:
    """The piece of each word, by falling count, when they are cut into pieces of about equal mass."""
    mass = np.cumsum(counts) - counts / 2
    return np.minimum(pieces - 1, (mass / max(1, counts.sum()) * pieces).astype(np.int64))


def vocabulary(words: list[bytes], counts: np.ndarray, groups: np.ndarray, n_all: int, n_words: int) -> Vocabulary:
    """``words`` by falling count; ``groups`` of the first ones, -1 where unknown."""
    endings = Endings.of(words, groups)
    group = np.array([g if g >= 0 else endings.group(w) for w, g in zip(words, [*groups.tolist(), *repeat(-1, len(words))], strict=False)], np.int64)
    classes, parts, smooth = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), counts + ALPHA
    for g in range(GROUPS):
        own = np.flatnonzero(group == g)
        classes[own] = g * PER_GROUP + cut(counts[own], PER_GROUP)
    for c in range(CLASSES - GROUPS):
        own = np.flatnonzero(classes == c)
        parts[own] = cut(counts[own], PARTS)
    sums = np.bincount(classes, weights=smooth, minlength=CLASSES)
    in_class = np.log10(smooth / sums[classes]) if len(words) else np.zeros(0)
    place = classes * PARTS + parts
    in_part = np.log10(smooth / np.bincount(place, weights=smooth)[place]) if len(words) else np.zeros(0)
    base = np.log10(smooth / (n_all + ALPHA * (n_words + 1)))
    outside, none = CLASSES - GROUPS + np.arange(GROUPS), np.zeros(GROUPS)
    return Vocabulary(
        words, counts, endings, np.append(classes, outside), np.append(in_class, none),
        np.append(parts, none.astype(np.int64)), np.append(in_part, none), np.append(base, none), buckets(n_all),
    )


def pair_feature(context: np.ndarray) -> np.ndarray:
    return mixed(context) % PAIRS


def features(context: np.ndarray) -> np.ndarray:
    """The rows of the weights that a context switches on."""
    return np.stack([np.zeros_like(context), 1 + context // SKIP, 1 + BEFORE + context % SKIP, 1 + BEFORE + SKIP + pair_feature(context)], axis=1)


N_FEATURES = 1 + BEFORE + SKIP + PAIRS
OUTER = BEFORE * SKIP * CLASSES  # cells of classes after contexts


def log_shares(weights: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Natural logarithms of the classes' probabilities per context."""
    logits = weights[features(context)].sum(axis=1)
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def context_counts(docs: DataFrame, shared) -> DataFrame:
    """``(at, n)`` over all of ``text``: classes after their contexts, and from ``OUTER`` on parts after theirs."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: Vocabulary = shared.value
        head = _array(own.words)
        total = np.zeros(OUTER + CLASSES * own.buckets * PARTS, np.int32)
        for piece in (piece for frame in frames for piece in pieces(frame["text"])):
            ids, starts = own.read(Tokens.of(piece), head)
            for cells in (
                own.contexts(ids, starts) * CLASSES + own.classes[ids],
                OUTER + own.inner_contexts(ids, starts) * PARTS + own.parts[ids],
            ):
                at, n = np.unique(cells, return_counts=True)
                total[at] += n.astype(np.int32)
        at = np.flatnonzero(total)
        for some in np.array_split(at, 1 + len(at) // FLUSH):
            yield pd.DataFrame({"at": some, "n": total[some].astype(np.int64)})

    counted = docs.select(whole("text").alias("text")).mapInPandas(count, "at long, n long")
    return counted.groupBy("at").agg(F.sum("n").alias("n"))


def fit_parts(table: DataFrame, buckets: int, steps: int = STEPS) -> np.ndarray:
    """Base-10 logarithms of a part's probability, by class and bucket; ``table`` holds ``(class, bucket, part, n)``.

    Each class is fitted by one task, on at most ``buckets * PARTS`` rows: a bias and a weight per bucket.
    """

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros((buckets, PARTS))
        seen[rows["bucket"].to_numpy(np.int64), rows["part"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
        used = np.flatnonzero(seen.sum(axis=0))  # a part without words has no share
        seen = seen[:, used]
        total, weights = seen.sum(axis=1, keepdims=True), np.zeros_like(seen)
        bias = np.log(seen.sum(axis=0) / seen.sum())
        for step in range(steps + 1):
            logits = bias + weights
            logits -= logits.max(axis=1, keepdims=True)
            shares = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
            if step < steps:
                share = np.exp(shares)
                up, bend = seen - total * share, total * share * (1 - share)
                weights += RATE * np.clip((up - PART_RIDGE * weights) / (bend + PART_RIDGE), -MOST, MOST)
        out = np.full((buckets, PARTS), -np.inf, np.float32)
        out[:, used] = shares / np.log(10)
        return pd.DataFrame({"class": [key[0]], "shares": [out.tobytes()]})

    found = table.groupBy("class").applyInPandas(one, "class long, shares binary").toArrow()  # one row a class
    out = np.zeros((CLASSES, buckets, PARTS), np.float32)
    for c, shares in zip(found["class"].to_pylist(), found["shares"].to_pylist(), strict=True):
        out[c] = np.frombuffer(shares, np.float32).reshape(buckets, PARTS)
    return out.reshape(-1, PARTS)


def fit(table: DataFrame, steps: int = STEPS) -> np.ndarray:
    """Weights ``(feature, class)``; ``table`` holds ``(context, class, n)`` with a context's rows in one partition."""
    weights = np.zeros((N_FEATURES, CLASSES))
    alone = np.full(CLASSES, 0.5)
    for r in table.groupBy("class").agg(F.sum("n").alias("n")).collect():  # one row a class
        alone[r["class"]] += r["n"]
    weights[0] = np.log(alone / alone.sum())
    held = np.where(np.arange(weights.size) < CLASSES, 0.0, RIDGE)
    for _ in range(steps):
        shared = table.sparkSession.sparkContext.broadcast(weights)

        def gradient(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            parts = list(frames)  # a part of a table of fixed size
            if not parts:
                return
            rows = pd.concat(parts, ignore_index=True)
            places, at = np.unique(rows["context"].to_numpy(np.int64), return_inverse=True)
            seen = np.zeros((len(places), CLASSES))
            seen[at, rows["class"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
            total = seen.sum(axis=1, keepdims=True)
            share = np.exp(log_shares(shared.value, places))
            up, bend = np.zeros((N_FEATURES, CLASSES)), np.zeros((N_FEATURES, CLASSES))
            on = features(places)
            for j in range(on.shape[1]):
                np.add.at(up, on[:, j], seen - total * share)
                np.add.at(bend, on[:, j], total * share * (1 - share))
            hit = np.flatnonzero(bend)
            yield pd.DataFrame({"at": hit, "up": up.ravel()[hit], "bend": bend.ravel()[hit]})

        found = table.mapInPandas(gradient, "at long, up double, bend double").groupBy("at").agg(F.sum("up").alias("up"), F.sum("bend").alias("bend"))
        found = found.toArrow()  # at most one row per weight
        at, up, bend = (found[c].to_numpy() for c in ("at", "up", "bend"))
        flat = weights.reshape(-1).copy()
        flat[at] += RATE * np.clip((up - held[at] * flat[at]) / (bend + RIDGE), -MOST, MOST)
        weights = flat.reshape(weights.shape)
        shared.unpersist()
    return weights


def score(docs: DataFrame, text: str = "text", key: str = "doc_id", head: int = HEAD, steps: int = STEPS) -> DataFrame:
    """``key`` with ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Scores are base-10 logarithms of a whole text's probability: ``base_score`` under
    smoothed single-word counts, ``score`` under the model; both from the rows that are
    not held out (a NULL key is not).  A text is its words and one end; NULL is empty.
    Rows are scored alone and all kept, repeated ones too.  Without training rows every
    word is unseen.  Other columns are not read.
    """
    spark = docs.sparkSession
    training = docs.where(~held_out(key)).select(F.col(text).alias("text"))
    counts = stored(word_counts(training), "words")
    n_words, n_all = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    limit = _head_limit(counts, head)
    top = counts.where(F.col("n") >= limit).toArrow()  # at most ``head`` rows
    found, sizes = top["word"].to_pylist(), top["n"].to_numpy()
    order = sorted(range(len(found)), key=lambda i: (-int(sizes[i]), found[i]))
    found, sizes = [found[i] for i in order], sizes[order].astype(np.int64)
    followed = np.zeros(PLACED * NEIGHBOURS)
    pairs = neighbour_counts(training, spark.sparkContext.broadcast(found[:PLACED])).toArrow()  # at most PLACED * NEIGHBOURS rows
    followed[pairs["at"].to_numpy()] = pairs["n"].to_numpy()
    groups = grouped(followed.reshape(PLACED, NEIGHBOURS))[: len(found)]
    words = vocabulary(found, sizes, groups, n_all, n_words)
    shared = spark.sparkContext.broadcast(words)
    table = stored(context_counts(training, shared), "contexts")
    outer = table.where(F.col("at") < OUTER).select(F.expr(f"at div {CLASSES}").alias("context"), (F.col("at") % CLASSES).alias("class"), "n")
    weights = fit(stored(outer.repartition("context"), "outer"), steps)
    shares = log_shares(weights, np.arange(BEFORE * SKIP)).astype(np.float64) / np.log(10)
    inner = table.where(F.col("at") >= OUTER).withColumn("at", F.col("at") - OUTER)
    inner = inner.select(
        F.expr(f"at div {PARTS * words.buckets}").alias("class"),
        F.expr(f"at div {PARTS} % {words.buckets}").alias("bucket"),
        (F.col("at") % PARTS).alias("part"),
        "n",
    )
    part_shares = fit_parts(inner.where(F.col("class") < CLASSES - GROUPS), words.buckets, steps)
    ready = spark.sparkContext.broadcast((words, shares, part_shares))

    @F.pandas_udf("n_tokens long, head long, base double, own double, words array<binary>, times array<int>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, shares, part_shares = ready.value
        head, size = _array(own.words), len(own.words)

        def one(texts: pd.Series) -> pd.DataFrame:
            toks = Tokens.of(texts)
            ids, starts = own.read(toks, head)
            value = shares[own.contexts(ids, starts), own.classes[ids]] + own.in_part[ids] + part_shares[own.inner_contexts(ids, starts), own.parts[ids]]
            # Words outside the head, with how often each text has them.
            other = np.flatnonzero(np.delete(ids, np.append(starts[1:], len(ids)) - 1) >= size)
            rest = toks.words.take(pa.array(other)).dictionary_encode()
            different = max(1, len(rest.dictionary))
            pairs, times = np.unique(toks.text[other] * different + rest.indices.to_numpy(), return_counts=True)
            words = np.array(rest.dictionary.to_pylist(), object)[pairs % different]
            cuts = np.searchsorted(pairs // different, np.arange(1, toks.count))
            rows = {
                "n_tokens": np.diff(np.append(starts, len(ids))),
                "head": np.add.reduceat((ids < size).astype(np.int64), starts),
                "base": np.add.reduceat(own.base[ids], starts),
                "own": np.add.reduceat(value, starts),
            }
            return pd.DataFrame(rows | {"words": [w.tolist() for w in np.split(words, cuts)], "times": np.split(times.astype(np.int32), cuts)})

        for texts in batches:
            yield pd.concat([one(piece) for piece in pieces(texts)], ignore_index=True)

    # The row number is fixed once it is written; it tells repeated rows apart.
    rows = docs.withColumns({"_m": measure(whole(text)), "_row": F.monotonically_increasing_id()})
    slim = stored(rows.select("_row", F.col(key).alias("_key"), "_m.*"), "measured")
    rare = slim.select("_row", F.explode(F.arrays_zip("words", "times")).alias("z")).select("_row", F.col("z.words").alias("word"), F.col("z.times").alias("k"))
    known = counts.where(F.col("n") < limit)

    @F.pandas_udf("int")
    def group_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for own in batches:
            yield own.map(shared.value.endings.group).astype("int32")

    mass = known.groupBy(group_of("word").alias("g")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()  # one row a group
    totals = {g: ALPHA for g in range(GROUPS)} | {r["g"]: r["n"] + ALPHA * (r["words"] + 1) for r in mass}
    total_of = F.element_at(F.array(*(F.lit(float(totals[g])) for g in range(GROUPS))), group_of("word") + 1)
    joined = rare.join(known, "word", "left").withColumn("_total", total_of)
    smooth = F.coalesce("n", F.lit(0)) + ALPHA
    sums = joined.groupBy("_row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("known"),
        F.sum(F.col("k") * F.log10(smooth / (n_all + ALPHA * (n_words + 1)))).alias("rare_base"),
        F.sum(F.col("k") * F.log10(smooth / F.col("_total"))).alias("rare_own"),
    )
    total = slim.drop("words", "times").join(sums, "_row", "left")
    return total.select(
        F.col("_key").alias(key),
        held_out("_key").alias("held_out"),
        "n_tokens",
        (F.col("head") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("own") + F.coalesce("rare_own", F.lit(0.0))).alias("score"),
    )
