"""Toxicity of texts after undoing obfuscation with a noisy channel.

A writer's plain letters reach us through a channel that swaps them for look-alikes
(``1d10t``), repeats them (``stuuupid``), puts marks or spaces between them (``i d i o
t``).  An odd token becomes a lattice: every observed sign may stand for itself, for the
letters it looks like, or for nothing, each at a cost; the space between single signs
may end a word or stand for nothing.  Viterbi decoding picks the path of least cost under
a model of letter triples, which is counted over all texts.  The plain reading stays
beside the decoded one.

Words that the labelled texts tell to be toxic are arcs of the lattice too: inside a run
of single signs, over pieces (``stu pid``) of which one at least is no ordinary word, and
under doubled letters (``looser``) unless the token is itself an ordinary word.

Restored words and their beginnings carry evidence: the log odds of standing in a toxic
text, learned from labelled rows, less one standard error.  A logistic function of the
two strongest different words of a text is its score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import unit_interval, whole
from tallyloom.session import stored

LABELLED = 20_000  # the most labelled rows that the classifier is fitted on
FEATURES = 50_000  # the most features it keeps, the strongest first
LEAST_ROWS = 5  # toxic rows a feature must stand in
STEMS = (4, 5, 6)  # lengths of the beginnings that count besides the word
SPACED = 3  # that many single signs in a row may spell words
ARC_LETTERS = 32  # toxic words up to this length are arcs over pieces and single signs
SIGNS = 28  # word edge, 26 letters, any other letter
CACHED = 300_000  # tokens whose evidence a task remembers

# What a sign may stand for.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou",
}
LOOK_COST, WILD_COST, DROP_COST, KEEP_COST, TWICE_COST, AGAIN_COST, JOIN_COST = 0.5, 2.0, 0.7, 8.0, 2.5, 0.1, 0.3

_EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "«»“”„…–—¿¡"
_OUTER = "".join(c for c in _EDGES if c not in LOOKS or c in "*(")
_AGAIN = re.compile(r"(.)\1+")
_RUNS = re.compile(b"\x01{%d,}" % SPACED)
_CODES = np.zeros(256, np.int64)
for _i in range(26):
    _CODES[97 + _i] = _CODES[65 + _i] = _i + 1
_CODES[128:] = 27


def sign_code(sign: str) -> int:
    return ord(sign) - 96 if "a" <= sign <= "z" else 27


def triple_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How often each triple of signs stands in all the texts, as a 28 x 28 x 28 array."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SIGNS**3, np.int64)
        for frame in frames:
            for one in frame["text"]:
                raw = b" " + one.encode() + b" "
                for low in range(0, len(raw) - 2, 4_000_000):
                    codes = _CODES[np.frombuffer(raw[low : low + 4_000_002], np.uint8)]
                    total += np.bincount((codes[:-2] * SIGNS + codes[1:-1]) * SIGNS + codes[2:], minlength=SIGNS**3)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"triple": seen.astype(np.int32), "n": total[seen]})

    counted = docs.select(whole(text).alias("text")).mapInPandas(count, "triple int, n long")
    rows = counted.groupBy("triple").agg(F.sum("n").alias("n")).collect()  # at most 28**3 rows
    out = np.zeros(SIGNS**3)
    for r in rows:
        out[r["triple"]] = r["n"]
    return out.reshape(SIGNS, SIGNS, SIGNS)


def letter_costs(counts: np.ndarray) -> np.ndarray:
    smooth = counts + 0.1
    return -np.log(smooth / smooth.sum(axis=2, keepdims=True))


def odd(token: str) -> bool:
    """Whether a lower-case token without marks at its edges may hide a word."""
    if token.isalpha():
        return bool(_AGAIN.search(token))
    return any(c.isalpha() for c in token) and all(c.isalpha() or c in LOOKS or c in "-_.'~^" for c in token)


def decode(token: str, costs: np.ndarray) -> str:
    """The likeliest plain word behind an odd token: Viterbi over the last two letters.

    A space in ``token`` may stay, which ends a word, or vanish.
    """
    paths: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    last, times = "", 0
    for sign in token:
        times = times + 1 if sign == last else 1
        last = sign
        arcs: list[tuple[str, float]] = []
        if sign == " ":
            arcs += [(" ", 0.0), ("", JOIN_COST)]
        elif sign.isalpha():
            arcs.append((sign, 0.0))
            if times > 1:
                arcs.append(("", AGAIN_COST if times > 2 else TWICE_COST))
        elif sign in LOOKS:
            arcs += [(c, WILD_COST if sign == "*" else LOOK_COST) for c in LOOKS[sign]]
            arcs.append(("", KEEP_COST if times == 1 and sign.isdigit() else DROP_COST + (sign != "*")))
        else:
            arcs.append(("", DROP_COST))
        step: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, letters) in paths.items():
            for letter, price in arcs:
                if letter:
                    c = 0 if letter == " " else sign_code(letter)
                    key, reached, way = (b, c), cost + price + costs[a, b, c], (letters, letter)
                else:
                    key, reached, way = (a, b), cost + price, letters
                if key not in step or reached < step[key][0]:
                    step[key] = (reached, way)
        paths = step
    best = min(((cost + costs[a, b, 0], way) for (a, b), (cost, way) in paths.items()), key=lambda x: x[0])[1]
    out = []
    while best:
        best, letter = best
        out.append(letter)
    return "".join(reversed(out))


def spaced(words: list[str]) -> list[str]:
    """Words that single signs in a row spell out."""
    if len(words) < SPACED:
        return []
    single = bytes([1 if len(w) == 1 else 0 for w in words])
    return ["".join(words[m.start() : m.end()]) for m in _RUNS.finditer(single)]


def collapsed(word: str) -> str:
    return _AGAIN.sub(r"\1", word)


class Arcs:
    """Toxic words as arcs of the lattice; ``ordinary`` words are not read otherwise.

    ``evidence`` names all features that count; without it every word may matter.
    """

    def __init__(self, toxic: Iterable[str] = (), ordinary: Iterable[str] = (), evidence: Iterable[str] | None = None):
        self.starts = None if evidence is None else {collapsed(f.removeprefix("=")) for f in evidence}
        self.toxic = {w for w in toxic if 3 < len(w) <= ARC_LETTERS}
        self.ordinary = frozenset(ordinary)
        self.begins = {w[:k] for w in self.toxic for k in range(1, len(w))}
        self.bare: dict[str, list[str]] = {}
        for word in sorted(self.toxic):
            self.bare.setdefault(collapsed(word), []).append(word)

    def doubled(self, word: str) -> list[str]:
        """Toxic words that differ from ``word`` in repeated letters only."""
        return [] if word in self.ordinary else self.bare.get(collapsed(word), [])

    def matters(self, word: str) -> bool:
        """Whether leaving out repeated letters of ``word`` can show evidence.

        All such readings share the word's collapsed form, so evidence of one, a word
        or a beginning, is a beginning of that form when it is collapsed itself.
        """
        if word in self.ordinary:
            return False
        bare = collapsed(word)
        return self.starts is None or bare in self.starts or any(bare[:k] in self.starts for k in range(1, STEMS[-1] + 1))

    def joined(self, words: list[str]) -> set[str]:
        """Toxic words that two or more neighbouring pieces spell."""
        begins, found = self.begins, set()
        for i in [i for i, w in enumerate(words) if w in begins]:
            text, strange = words[i], words[i] not in self.ordinary
            for piece in words[i + 1 : i + ARC_LETTERS]:
                plain = piece.strip(_EDGES)
                text, strange = text + plain, strange or plain not in self.ordinary
                if strange and text in self.toxic:
                    found.add(text)
                if piece != plain or text not in begins:
                    break
        return found

    def inside(self, run: str) -> set[str]:
        """The toxic words of the cheapest cut of ``run``: a letter outside them costs one."""
        if not self.toxic:
            return set()
        best: list[tuple[int, str]] = [(0, "")]
        for stop in range(1, len(run) + 1):
            least = (best[-1][0] + 1, "")
            for start in range(max(0, stop - ARC_LETTERS), stop - 3):
                if best[start][0] < least[0] and run[start:stop] in self.toxic:
                    least = (best[start][0], run[start:stop])
            best.append(least)
        found, stop = set(), len(run)
        while stop:
            word = best[stop][1]
            found.add(word)
            stop -= len(word) or 1
        return found - {""}


@dataclass
class Reader:
    """Restores tokens and gives their features; remembers a bounded number of tokens."""

    costs: np.ndarray
    arcs: Arcs = field(default_factory=Arcs)
    cache: dict = field(default_factory=dict)

    def restore(self, token: str) -> str:
        plain = token.strip(_EDGES)
        return decode(plain, self.costs) if odd(plain) and plain not in self.arcs.ordinary else plain

    def readings(self, token: str) -> set[str]:
        """The word without marks at its edges as it stands and restored, and with marks that look like letters: ``$tupid``."""
        plain, edged = token.strip(_EDGES), token.strip(_OUTER)
        found = {plain}
        if odd(plain) and (not plain.isalpha() or self.arcs.matters(plain)):
            found.add(decode(plain, self.costs))
        if edged != plain and odd(edged):
            found.add(decode(edged, self.costs))
        for word in [w for w in found if _AGAIN.search(w)]:
            found.update(self.arcs.doubled(word))
        return found

    def features(self, token: str) -> tuple[str, ...]:
        found = self.cache.get(token)
        if found is None:
            words = (token,) if token.isalpha() and not _AGAIN.search(token) else [w for w in self.readings(token) if w]
            found = tuple({f for w in words for f in (f"={w}", *(w[:k] for k in STEMS if len(w) > k))})
            if len(self.cache) >= CACHED:
                self.cache.clear()
            self.cache[token] = found
        return found

    def split(self, run: str) -> list[str]:
        """The words that the single signs of ``run`` spell, as the letters' model cuts them."""
        return decode(" ".join(run), self.costs).split()

    def tokens(self, text: str) -> set[str]:
        """The text's words, what its runs of single signs spell, and toxic words that its pieces join to."""
        words = text.lower().split()
        found = set(words)
        for run in set(spaced(words)):
            parts = self.split(run)
            found.update(parts, (run,), self.arcs.inside("".join(parts)), self.arcs.inside(run))
        return found | self.arcs.joined(words)


@dataclass(frozen=True)
class Model:
    costs: np.ndarray
    evidence: dict[str, float]
    weights: tuple[float, float, float]
    ordinary: frozenset[str] = frozenset()

    def reader(self) -> Reader:
        return Reader(self.costs, Arcs((f[1:] for f in self.evidence if f[0] == "="), self.ordinary, self.evidence))

    def strongest(self, reader: Reader, memory: dict, text: str) -> tuple[float, float]:
        """The evidence of the two strongest different words."""
        first = second = 0.0
        for token in reader.tokens(text):
            value = memory.get(token)
            if value is None:
                value = max((self.evidence.get(f, 0.0) for f in reader.features(token)), default=0.0)
                if len(memory) >= CACHED:
                    memory.clear()
                memory[token] = value
            if value > first:
                first, second = value, first
            elif value > second:
                second = value
        return first, second

    def score(self, pairs: np.ndarray) -> np.ndarray:
        bias, one, two = self.weights
        return 1.0 / (1.0 + np.exp(-np.clip(bias + pairs @ np.array([one, two]), -60, 60)))


def labelled_rows(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, rows: int) -> DataFrame:
    """``(text, label)`` of at most ``rows`` labelled documents that are not held out, the choice a digest of the id."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(F.col(label).cast("int")).alias("label"))
    known = known.where(~held_out(key)).orderBy(unit_interval("label", F.col(key)), key).limit(rows)
    texts = docs.select(F.col(key).alias("_key"), whole(text).alias("text"))
    picked = texts.join(F.broadcast(known), F.col("_key") == F.col(key))  # at most ``rows`` pairs of numbers
    return picked.select("text", "label")


def held_out(key: str, folds: int = 5):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == 0, F.lit(False))


def _fit(pairs: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Logistic weights by Newton steps with a small ridge; a bias alone if there is one class only."""
    x = np.column_stack((np.ones(len(pairs)), pairs)) if len(pairs) else np.zeros((0, 3))
    w = np.zeros(3)
    ridge = np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (labels - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, w))


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", rows: int = LABELLED
) -> Model:
    """Letter costs from all texts, evidence and weights from at most ``rows`` labelled ones."""
    costs = letter_costs(triple_counts(docs, text))
    sample = stored(labelled_rows(docs, labels, text, key, label, rows), "labelled")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(costs)
        for frame in frames:
            for low in range(0, len(frame), 500):
                part, toxic, clean = frame.iloc[low : low + 500], Counter(), Counter()
                for one, mark in zip(part["text"], part["label"], strict=True):
                    (toxic if mark else clean).update({f for t in reader.tokens(one) for f in reader.features(t)})
                names = list(toxic.keys() | clean.keys())
                yield pd.DataFrame({"feature": names, "toxic": [toxic[f] for f in names], "clean": [clean[f] for f in names]})

    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}  # two rows
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    totals = sample.mapInPandas(count, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    totals = stored(totals, "features")
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (n_toxic + 1)) - F.log(b / (n_clean + 1)) - F.sqrt(1 / a + 1 / b)
    strong = totals.where(F.col("toxic") >= LEAST_ROWS).withColumn("odds", odds).where("odds > 0.5")
    evidence = {r["feature"]: r["odds"] for r in strong.orderBy(F.desc("odds"), "feature").limit(FEATURES).collect()}
    common = totals.where((F.col("clean") >= LEAST_ROWS) & F.col("feature").startswith("="))
    ordinary = frozenset(r["feature"][1:] for r in common.orderBy(F.desc("clean"), "feature").limit(FEATURES).collect())
    model = Model(costs, evidence, (0.0, 0.0, 0.0), ordinary)

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, memory = model.reader(), {}
        for frame in frames:
            pairs = [model.strongest(reader, memory, one) for one in frame["text"]]
            yield pd.DataFrame({"one": [p[0] for p in pairs], "two": [p[1] for p in pairs], "label": frame["label"]})

    seen = sample.mapInPandas(measure, "one double, two double, label int").toPandas()  # at most ``rows`` rows
    seen = seen.sort_values(["one", "two", "label"])
    return Model(costs, evidence, _fit(seen[["one", "two"]].to_numpy(float), (seen["label"].to_numpy() > 0).astype(float)), ordinary)


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is toxic.

    Only the whole text is read; NULL is an empty text, which gets the score of a text
    without evidence.  Rows are judged alone, so repeated rows get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by FEATURES and 28**3 costs

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        reader, memory = own.reader(), {}
        for texts in batches:
            pairs = np.array([own.strongest(reader, memory, t) for t in texts], dtype=float).reshape(-1, 2)
            yield pd.Series(own.score(pairs))

    return docs.withColumn(out, of(whole(text)))


def restored(docs: DataFrame, model: Model, text: str = "text", out: str = "restored") -> DataFrame:
    """``docs`` with the text's tokens restored, ordinary words as they stand, single signs as the words that they spell."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        reader = shared.value.reader()

        def one(t: str) -> str:
            words = t.lower().split()
            single = bytes([1 if len(w) == 1 else 0 for w in words])
            parts, at = [], 0
            for m in _RUNS.finditer(single):
                parts += [*map(reader.restore, words[at : m.start()]), *reader.split("".join(words[m.start() : m.end()]))]
                at = m.end()
            return " ".join(p for p in [*parts, *map(reader.restore, words[at:])] if p)

        return texts.map(one)

    return docs.withColumn(out, of(whole(text)))


def judged(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", limit: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` of a model trained on the labelled rows that are not held out."""
    found = scored(docs, train(docs, labels, text, key), text)
    return found.withColumn("predicted", (F.col("score") >= limit).cast("int"))

