"""Each operator on odd rows, on an empty table, and against a brute-force version."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_samples import sentence
from tallyloom.llm import decontam, maxent, mixing, pii, search, sharding, simhash, substrings, toxicity, urllists
from tallyloom.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


# 1 mixing


def test_mix_meets_targets_and_limits(spark, odd_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        assert r["size"] == len(words(r["text"])) and 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], []).append(r)
    for own in by.values():
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        assert own[0]["target"] <= 2 * own[0]["source_size"] + 1e-9
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= len(own)
    total = sum(r["size"] for r in rows)
    assert math.isclose(sum(own[0]["target"] for own in by.values()), 1.5 * total)


def test_mix_agrees_with_itself_and_takes_no_rows(odd_docs, no_docs):
    first, again = (sorted(map(str, mixing.mix(odd_docs).select("doc_id", "size", "taken").collect())) for _ in range(2))
    assert first == again
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mixed_rows(odd_docs).columns == odd_docs.columns


# 2 search


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=20)]) for i in range(400)]
    rows += [(400, None), (401, [None] + [0.1] * 19), (402, [float("nan")] * 20), (403, [float("inf")] * 20), (404, []), (20, rows[20][1]), (405, [0.5, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("vec_id", search.quantised("embedding").alias("v"))
    got = {}
    for r in search.nearest(df, df.where("vec_id % 20 = 0"), k=7).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    fine = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for at, (i, q) in enumerate(fine):
        if i % 20 == 0:
            others = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for n, (j, v) in enumerate(fine) if n != at)[:7]
            want = [(rank, j, -s) for rank, (s, j) in enumerate(others, 1)]
            assert sorted(got[i])[:: 2 if i == 20 else 1] == want
    assert search.nearest(df.limit(0), df.limit(0)).count() == 0


# 3 language model


def test_language_model_base_and_mass(spark, odd_docs, no_docs):
    docs = odd_docs.unionByName(odd_docs.withColumn("doc_id", F.col("doc_id") + 100))
    got = maxent.score(docs, head=50, steps=3).collect()
    assert len(got) == docs.count() and maxent.score(no_docs).count() == 0
    rows = docs.collect()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    tokens = lambda t: [w.lower() for w in words(t)] + [""]
    counts = Counter(w for r in rows if not out(r["doc_id"]) for w in tokens(r["text"]))
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(r["doc_id"]), len(tokens(r["text"])), round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(r["text"])), 6)) for r in rows
    )
    assert sorted((str(r["doc_id"]), r["n_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["train_tokens"] == n and r["score"] < 0 for r in got)


def test_language_model_is_a_distribution():
    found, sizes = [b"", b"the", b"of", b"der", b"cat"], np.array([50, 40, 30, 20, 10])
    own = maxent.vocabulary(found, sizes, np.array([0, 0, 0, 1, -1]), 160, 8)
    shares = np.exp(maxent.log_shares(np.random.default_rng(1).normal(size=(maxent.N_FEATURES, maxent.CLASSES)), np.arange(50)))
    assert np.allclose(shares.sum(axis=1), 1)
    per_class = np.bincount(own.classes[:5], weights=10 ** own.in_class[:5], minlength=maxent.CLASSES)
    assert np.allclose(per_class[per_class > 0], 1)


def test_contexts_by_hand():
    texts = ["the cat saw The\tdog", "", " odd  the", "x", "the the the"]
    found = [b"", b"the", b"cat", b"dog"]
    own = maxent.vocabulary(found, np.array([5, 5, 1, 1]), np.array([0, 1, 2, 2]), 12, 6)
    ids, starts = own.read(maxent.Tokens.of(pd.Series(texts)), maxent._array(found))
    want, outer, inner = [], [], []
    for text in texts:
        one = [found.index(w) if w in found else len(found) + own.endings.group(w) for w in [*text.lower().encode().split(), b""]]
        want.append(one)
        for at, word in enumerate(one):
            before = one[at - 1] if at else None
            bucket = maxent.BEFORE - 1 if before is None else before if before < maxent.OWN else maxent.OWN + own.classes[before]
            outer.append(bucket * maxent.SKIP + (own.classes[one[at - 2]] if at > 1 else maxent.SKIP - 1))
            inner.append(own.classes[word] * own.buckets + (own.buckets - 1 if before is None else own.inner_before[before]))
    assert ids.tolist() == sum(want, []) and starts.tolist() == np.cumsum([0] + [len(w) for w in want[:-1]]).tolist()
    assert own.contexts(ids, starts).tolist() == outer and own.inner_contexts(ids, starts).tolist() == inner


def test_model_learns_pairs_and_beats_the_base(spark):
    rng = np.random.default_rng(7)
    kept = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10]
    held = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0]
    pair = lambda i, j: f"first{i:02d} second{j:02d}"
    draw = lambda: " ".join(pair(i, i) for i in rng.integers(0, 20, 30))
    rows = [(i, draw()) for i in kept[:600]] + [(i, draw()) for i in held[:30]]
    rows += [(held[40], " ".join(pair(i, i) for i in range(20))), (held[41], " ".join(pair(i, (i + 7) % 20) for i in range(20)))]
    got = {r["doc_id"]: r for r in maxent.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    held_rows = [got[i] for i in held[:30]]
    gain = sum(r["score"] - r["base_score"] for r in held_rows) / sum(r["n_tokens"] for r in held_rows)
    assert gain > 0.3
    seen, unseen = got[held[40]], got[held[41]]
    assert seen["base_score"] == pytest.approx(unseen["base_score"]) and seen["score"] > unseen["score"] + 5


# 4 URL lists


def test_intervals_and_judgement(spark):
    entries = spark.createDataFrame(
        [
            ("host", "a.b.org", "2024-01-10", "add"), ("host", "a.b.org", "2024-01-20", "remove"), ("host", "a.b.org", "2024-01-20", "add"),
            ("host", "a.b.org", "2024-02-01", "remove"), ("host", "a.b.org", "2024-02-05", "remove"), ("domain", "b.org", "2024-01-15", "add"),
            ("domain", "b.org", "2024-01-15", "add"), ("path", "c.org/x", "2024-01-01", "add"), ("other", "c.org", "2024-01-01", "add"),
            (None, "c.org", "2024-01-01", "add"), ("host", None, "2024-01-01", "add"), ("host", "c.org", None, "add"), ("host", "c.org", "2024-01-01", None),
            ("host", "d.org", "2024-01-01", "remove"),
        ],
        "kind string, pattern string, listed_on string, action string",
    ).withColumn("listed_on", F.col("listed_on").cast("date"))
    captures = spark.createDataFrame(
        [
            (1, "http://A.b.org/q", "2024-01-09"), (2, "http://a.b.org/q", "2024-01-10"), (3, "http://u@a.b.org:80", "2024-01-31"), (4, "http://a.b.org", "2024-02-01"),
            (5, "http://c.org/x/y?z", "2024-01-01"), (6, "http://c.org/xx", "2024-01-01"), (7, None, "2024-01-20"), (8, "b.org", "2024-01-20"),
            (9, "http://b.org", None), (10, "http://notb.org", "2024-02-20"), (2, "http://a.b.org/q", "2024-01-10"), (11, "http://d.org", "2024-03-01"), (12, "", "2024-01-20"),
        ],
        "page_id int, url string, fetched_on string",
    ).withColumns({"fetched_on": F.col("fetched_on").cast("date"), "host": F.lit("clash"), "rule": F.lit(1)})
    got = {(r["page_id"], r["rule"]) for r in urllists.judge(captures, entries).collect()}
    assert got == {
        (1, None), (2, "a.b.org"), (3, "a.b.org"), (4, "b.org"), (5, "c.org/x"), (6, None), (7, None), (8, None), (9, None), (10, None), (11, None), (12, None),
    }
    assert urllists.judge(captures, entries).count() == 13
    assert urllists.judge(captures, entries.limit(0)).where("blocked").count() == 0
    assert urllists.judge(captures.limit(0), entries).count() == 0


# 5 shards


@pytest.mark.parametrize("at_once", [100_000, 300])
def test_shards(spark, odd_docs, no_docs, at_once, monkeypatch):
    monkeypatch.setattr(sharding.place, "__defaults__", (8, at_once, at_once // 5))
    more = spark.range(100, 1500).select(
        F.col("id").alias("doc_id"), F.repeat(F.md5((F.col("id") % 1000).cast("string")), (F.col("id") % 37).cast("int")).alias("text")
    )
    docs = odd_docs.unionByName(more, allowMissingColumns=True)
    rows = sharding.shard(docs).collect()
    assert len(rows) == docs.count() and sharding.shard(no_docs).count() == 0
    sums, slots, places = Counter(), {}, {}
    for r in rows:
        assert r["size"] == len((r["text"] or "").encode()) + 1
        assert r["text_crc32"] == (None if r["text"] is None else zlib.crc32(r["text"].encode()))
        sums[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        places.setdefault(r["text"], set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(p) == 1 for p in places.values())
    assert max(sums.values()) - min(sums.get(i, 0) for i in range(8)) < 0.05 * sum(sums.values()) / 8


def test_differencing_halves_a_classic():
    parts = sharding.difference(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(np.bincount(parts, weights=[8, 7, 6, 5, 4])) == [14, 16]
    assert len(sharding.difference(np.zeros(0, np.int64), 3)) == 0


# 6 personal data


def brute_pii(text):
    out, luhn = [], lambda d: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    digits = lambda s: re.sub("[^0-9]", "", s)
    valid = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m)),
        "phone": lambda m: 8 <= len(digits(m)) <= 15,
    }
    for kind, fine in valid.items():
        out += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pii.PLAIN[kind], text, re.ASCII) if fine(m.group())]
    return ",".join(out)


PII_TEXTS = [
    None, "", "a@b.c", "x a.b+c@d-e.f.g, +y@z.w", "a@b.co+x@d.e@f.g", "a@b..c@d.e", "1.2.3.4.5.6.7.8", "001.002.003.255 256.1.1.1 1.1.1.256",
    "4111 1111 1111 1111", "4111-1111-1111-1111 and 4111111111111112", "x4111 1111  1111 1111 4111111111111111 5", "1" * 5000, "1 " * 4000, "a" * 20000 + "@",
    "+1 (555) 123-4567 ext", "+49 30 1234 ++1234567890123456 +1.2", "é+4930123456é ñ@b.c é@b.c", "IBAN DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432 x",
    "DE89 3704 0044 0532 0130 01", "call +1-202-555-0143 mail me@x.org", ".".join(["1"] * 999),
]


def test_personal_data_against_plain_expressions(spark, no_docs):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(PII_TEXTS)], "doc_id int, text string, pii int")
    base = F.filter("pii", lambda s: s["kind"] != "iban")
    for r in pii.personal_data(docs).select("text", pii.span_texts(base).alias("got"), "pii").collect():
        assert r["got"] == brute_pii(r["text"] or ""), (r["text"] or "")[:60]
        assert all((r["text"])[s["start"] : s["stop"]] == s["value"] for s in r["pii"])
    found = pii.personal_data(docs).select("doc_id", pii.counted(F.col("pii"), "iban").alias("n")).where("n > 0").collect()
    assert {PII_TEXTS[r["doc_id"]][:4] for r in found} == {"IBAN", "GB82"}
    assert pii.personal_data(no_docs).count() == 0


# 7 toxicity


@pytest.fixture(scope="module")
def toxic_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    return docs, labels, toxicity.train(docs, labels)


def test_toxicity_on_held_out_rows(toxic_model):
    docs, labels, model = toxic_model
    known = docs.join(labels.where(toxicity.held_out("doc_id")), "doc_id")
    rows = toxicity.scored(known.select("text", "toxic"), model).select("toxic", "score").collect()
    assert sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in rows) >= 0.97 * len(rows)


def test_toxicity_restores(spark, toxic_model, odd_docs, no_docs):
    _, _, model = toxic_model
    reader = toxicity.Reader(model.costs)
    for hidden, plain in {"1d10t": "idiot", "m0r0n": "moron", "stuuupid": "stupid", "l.o.s.e.r": "loser", "p@thetic": "pathetic", "the": "the"}.items():
        assert reader.restore(hidden) == plain
    assert toxicity.spaced("so i d i o t of".split()) == ["idiot"]
    texts = spark.createDataFrame([("the of an 1d10t and a m0r0n in the",), ("you i d i o t and st00pid l0ser",), ("the of and to in the",)], "text string")
    low, high = min(p := [r["score"] for r in toxicity.scored(texts, model).collect()]), sorted(p)[1]
    assert low < 0.5 < high
    rows = toxicity.scored(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.scored(no_docs, model).count() == 0
    assert toxicity.restored(texts, model).collect()[1]["restored"].split()[1] == "idiot"


@pytest.mark.parametrize(
    "hidden",
    ["s t u p i d i d i o t and a l o s e r", "stuupid iddiot looser", "stu pid idi ot", "I d u m b a s t u p i d", "1 d 1 0 t and m 0 r 0 n"],
)
def test_toxicity_reads_spacing_and_repetition(spark, toxic_model, hidden):
    rows = toxicity.scored(spark.createDataFrame([(f"the of {hidden} in the",), ("the good of a feed to in",), ("a b c d e f",)], "text string"), toxic_model[2]).collect()
    scores = {r["text"]: r["score"] for r in rows}
    assert scores.pop(f"the of {hidden} in the") >= 0.5 and max(scores.values()) < 0.5


def test_toxic_arcs_leave_ordinary_words():
    arcs = toxicity.Arcs(["god", "damned", "loser", "stupid"], ["good", "lose", "r", "feed"])
    assert arcs.doubled("looser") == ["loser"] and arcs.doubled("good") == [] and arcs.doubled("loosers") == []
    assert arcs.joined("a stu pi d. of".split()) == {"stupid"} and arcs.joined("stu. pid".split()) == set()
    assert arcs.joined("lose r".split()) == set() and arcs.joined("los er".split()) == {"loser"}
    assert arcs.inside("alosershestupidx") == {"loser", "stupid"} and toxicity.Arcs().inside("ab") == set()
    gate = toxicity.Arcs(["stupid"], ["stuub"], ["=stupid", "moro"])
    assert all(map(gate.matters, ("stuupid", "mmooroonic"))) and not any(map(gate.matters, ("stuub", "mooss", "letter")))
    assert arcs.matters("letter") and arcs.joined([]) == set() and arcs.inside("") == set()


def test_decode_is_the_best_of_all_paths():
    rng = np.random.default_rng(5)
    costs = toxicity.letter_costs(rng.integers(0, 50, (28, 28, 28)))

    def cost_of(letters):
        codes = [0, 0, *(0 if c == " " else toxicity.sign_code(c) for c in letters), 0]
        return sum(costs[a, b, c] for a, b, c in zip(codes, codes[1:], codes[2:], strict=False))

    def paths(token):
        found, last, times = [("", 0.0)], "", 0
        for sign in token:
            times, last = (times + 1 if sign == last else 1), sign
            if sign == " ":
                arcs = [(" ", 0.0), ("", toxicity.JOIN_COST)]
            elif sign.isalpha():
                arcs = [(sign, 0.0)] + ([("", toxicity.TWICE_COST if times == 2 else toxicity.AGAIN_COST)] if times > 1 else [])
            elif sign in toxicity.LOOKS:
                arcs = [(c, toxicity.WILD_COST if sign == "*" else toxicity.LOOK_COST) for c in toxicity.LOOKS[sign]]
                arcs.append(("", toxicity.KEEP_COST if times == 1 and sign.isdigit() else toxicity.DROP_COST + (sign != "*")))
            else:
                arcs = [("", toxicity.DROP_COST)]
            found = [(way + letter, price + own) for way, price in found for letter, own in arcs]
        return found

    for _ in range(60):
        token = "".join(rng.choice(list("abo01$* -"), rng.integers(1, 8)))
        prices = {}
        for way, price in paths(token):
            prices[way] = min(prices.get(way, math.inf), price + cost_of(way))
        assert math.isclose(prices[toxicity.decode(token, costs)], min(prices.values()))


def test_toxicity_without_labels(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity.judged(odd_docs, none).collect()} <= {0, 1}


# 8 SimHash


def brute_print(text):
    own = (text or "").encode().lower().split()
    if not own:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(own[i : i + 4]), 42) for i in range(max(1, len(own) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(nodes, near):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_simhash_against_brute_force(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).select("doc_id", "text", simhash.as_hex(F.col("_print")).alias("p"), "component_id").collect()
    assert len(rows) == odd_docs.count() and simhash.near_duplicates(no_docs).count() == 0
    assert all(int(r["p"], 16) == brute_print(r["text"]) for r in rows)
    classes = brute_classes(sorted({int(r["p"], 16) for r in rows}), lambda a, b: (a ^ b).bit_count() <= 4)
    for r in rows:
        own = [q["doc_id"] for q in rows if classes[int(q["p"], 16)] == classes[int(r["p"], 16)] and q["doc_id"] is not None]
        assert r["component_id"] == (min(own) if own else None)


def test_links_in_a_crowd(spark):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(1 << 62))
    crowd = {centre ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 8))) for _ in range(500)} | {int(x) for x in rng.integers(0, 1 << 63, 200)}
    signed = [x - (1 << 64) if x >> 63 else x for x in crowd]
    found = simhash.classes(spark.createDataFrame([(x,) for x in signed], "p long")).collect()
    want = brute_classes(sorted(signed), lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4)
    assert {r["node"]: r["root"] for r in found} == dict(want)


def test_crowds_are_told_without_a_join_of_their_keys(spark, monkeypatch):
    # More nodes a key than hubs; the listings of a crowd are counted, not joined with the keys that are large.
    kinds, frame = [], type(spark.range(1))
    join = frame.join
    monkeypatch.setattr(frame, "join", lambda self, other, on=None, how=None: (kinds.append((how, on)), join(self, other, on, how))[1])
    rng = np.random.default_rng(21)
    crowd = {int(c) ^ sum(1 << int(b) for b in rng.integers(0, 62, rng.integers(0, 11))) for c in rng.integers(1 << 62, size=3) for _ in range(150)}
    found = simhash.classes(spark.createDataFrame([(x,) for x in crowd], "p long")).collect()
    assert {r["node"]: r["root"] for r in found} == brute_classes(sorted(crowd), lambda a, b: (a ^ b).bit_count() <= 4)
    assert len(kinds) > 4 and not any(how and "semi" in how for how, _ in kinds)


def test_one_of_each(spark, odd_docs, no_docs):
    near = sentence(3, 3000).replace(" ", " new ", 1)
    docs = odd_docs.unionByName(spark.createDataFrame([(20, near, "e"), (21, "one", "e"), (22, "two", "e")], "doc_id long, text string, source string"), allowMissingColumns=True)
    kept = sorted(str(r["doc_id"]) for r in simhash.one_of_each(docs).collect())
    assert kept == sorted(map(str, [1, 3, None, 7, 8, 9, 10, 10, 22]))
    assert simhash.one_of_each(no_docs).count() == 0


def brute_kept(texts, shingle=5, similarity=0.8):
    """The places of the texts that stay: the first of each group that links of Jaccard ``similarity`` connect."""
    split = [t.lower().split() for t in texts]
    sets = [{tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} for w in split]
    classes = brute_classes(range(len(texts)), lambda a, b: (n := len(sets[a] & sets[b])) >= similarity * (len(sets[a]) + len(sets[b]) - n))
    return sorted(set(classes.values()))


def kept_places(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(r["doc_id"] for r in simhash.one_of_each(docs).select("doc_id").collect())


def test_one_of_each_in_a_crowd(spark):
    rng, texts = np.random.default_rng(11), []
    for group in range(4):
        base = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        for _ in range(60):
            copy = list(base)
            for at in rng.integers(0, 300, 3 + group % 2):
                copy[at] = f"e{rng.integers(10**6)}"
            texts.append(" ".join(copy))
    assert kept_places(spark, texts) == brute_kept(texts)


def test_one_of_each_after_block_edits(spark):
    rng, texts = np.random.default_rng(12), []
    for _ in range(40):
        base = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        foreign = [f"f{x}" for x in rng.integers(0, 5000, 36)]
        texts += [" ".join(w) for w in (base, base[:255], base + foreign, base[:230], base[:150] + foreign[:12] + base[150:])]
    assert kept_places(spark, texts) == brute_kept(texts)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 90), (90, 100), (5, 5), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 90: 90, 100: 90}
    assert components(links.limit(0)).count() == 0


# 9 substrings


def brute_repeats(docs, span):
    seen, out = set(), []
    for _, text in docs:
        own, gone = words(text), set()
        for i in range(len(own) - span + 1):
            window = tuple(own[i : i + span])
            if window in seen:
                gone.update(range(i, i + span))
            seen.add(window)
        out.append((len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)))
    return out


def test_substrings_against_brute_force(spark, odd_docs, no_docs):
    a, b, c = sentence(11, 70), sentence(12, 25), sentence(13, 19)
    texts = [a, f"x {b} y {c}", f"{b} z {a} {b}", f"{c} q {c}", "w " * 90, "w " * 30, a[:200], None, "", f"new {a} end", sentence(14, 20), sentence(14, 20) + " t", "w w é " * 15]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r) for r in substrings.remove_repeats(docs).orderBy("doc_id").select("n_words", "n_removed", "kept").collect()]
    assert got == brute_repeats(list(enumerate(texts)), 20)
    # One document per key and text, versions of a key by checksum.
    rows = sorted({(-1 if r["doc_id"] is None else r["doc_id"], zlib.crc32((r["text"] or "").encode()) & 0xFFFF, r["text"]) for r in odd_docs.collect()}, key=lambda r: r[:2])
    want = {(r[0], *w) for r, w in zip(rows, brute_repeats([(r[0], r[2]) for r in rows], 20), strict=True)}
    got = substrings.remove_repeats(odd_docs).select(F.coalesce("doc_id", F.lit(-1)), "n_words", "n_removed", "kept").collect()
    assert {tuple(r) for r in got} == want
    assert substrings.remove_repeats(odd_docs).count() == odd_docs.count() and substrings.remove_repeats(no_docs).count() == 0


def test_substrings_of_texts_under_one_key(spark):
    # Two texts of one key whose checksums agree in the bits that order versions.
    seen, pair, i = {}, None, 0
    while pair is None:
        text = " ".join(f"k{i}x{j}" for j in range(25 + i % 40))
        other = seen.setdefault(zlib.crc32(text.encode()) & 0xFFFF, text)
        pair, i = (other, text) if len(other.split()) < len(text.split()) - 20 else None, i + 1
    short, long = pair
    for key in (None, 7):
        docs = spark.createDataFrame([(1, f"{long} end"), (key, short), (key, long)], "doc_id long, text string")
        if key is None:  # NULL is first, so the later one repeats
            want = {(None, len(short.split()), 0), (None, len(long.split()), 0), (1, len(long.split()) + 1, len(long.split()))}
        else:
            want = {(7, len(short.split()), 0), (7, len(long.split()), len(long.split())), (1, len(long.split()) + 1, 0)}
        assert {tuple(r) for r in substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed").collect()} == want


def test_word_hashes_tell_words_apart():
    rng = np.random.default_rng(5)
    texts = ["", " \t\n\v\f\r ", *(" ".join("ab\0é"[int(i)] * int(n) for i, n in zip(rng.integers(0, 4, 200), rng.integers(1, 140, 200), strict=True)) for _ in range(5)), "", "last"]
    hashes, begins = substrings.word_hashes([t.encode() for t in texts])
    split = [words(t) for t in texts]
    assert np.diff(begins).tolist() == [len(w) for w in split] and len(hashes) == begins[-1]
    pairs = set(zip(hashes.tolist(), (w for own in split for w in own), strict=True))
    assert len(pairs) == len({h for h, _ in pairs}) == len({w for _, w in pairs})


def test_windows_of_many_texts_at_once(monkeypatch):
    # A batch a text costs more than the work on a short text.
    texts = [sentence(i, 30) for i in range(50)] + [sentence(99, 9000)]
    place = [[3 << substrings.COUNT_BITS | 4]] * len(texts)
    batch = pa.RecordBatch.from_pydict({"id": range(len(texts)), "doc": range(len(texts)), "text": texts, "place": place})
    found = list(substrings._find_windows(20)(iter([batch])))
    assert len(found) <= 2 and sum(f.num_rows for f in found) == 4 * len(texts)
    monkeypatch.setattr(substrings, "PIECE", 200)  # however the texts are put together
    apart = list(substrings._find_windows(20)(iter([batch])))
    assert len(apart) > 10 and pa.Table.from_batches(apart).equals(pa.Table.from_batches(found).combine_chunks())


def test_substrings_of_neighbouring_and_long_texts(spark):
    # Windows do not run from a text into the next, and repeats are found across pieces and in long words.
    a, b = sentence(31, 40).split(), " ".join("x" * (60 + i) for i in range(22))
    texts = [" ".join(a[:30]), " ".join(a[:15]), " ".join(a[15:]), " ".join(a), f"{b} y", "", f"z {b}", sentence(32, 60_000), f"{sentence(33, 9)} {sentence(32, 60_000)[3000:90_000]}", "u v " * 40, "u v " * 11]
    rows = list(enumerate(texts))
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).orderBy("doc_id")
    assert [tuple(r) for r in got.select("n_words", "n_removed", "kept").collect()] == brute_repeats(rows, 20)


# 10 decontamination


def brute_hits(text, items):
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    own, gone, found = split(text), set(), set()
    for item, t in items:
        w = split(t)
        m = min(10, len(w))
        grams = {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if m else set()
        for i in range(len(own) - m + 1):
            if m and tuple(own[i : i + m]) in grams:
                gone.update(range(i, i + m))
                found |= {item} if item is not None else set()
    return len(own), len(gone), ",".join(sorted(map(str, found)))


@pytest.mark.parametrize("limit", [200_000, 0])
def test_decontamination_against_brute_force(spark, odd_docs, no_docs, limit, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", limit)
    items = [(1, sentence(21, 40)), (10, sentence(21, 12)), (2, "short one"), (3, None), (4, "ha " * 30), (5, ""), (None, sentence(22, 15)), (6, sentence(23, 10)), (6, sentence(24, 10))]
    texts = [sentence(21, 40), "x " + sentence(21, 40).upper() + ", y", sentence(21, 9), "a SHORT-One b", "ha, " * 14, "ha " * 9, None, "", sentence(22, 15), sentence(24, 10) + "!", sentence(25, 50)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_hit int")
    rows = decontam.contamination(docs, bench).orderBy("doc_id").collect()
    for r, t in zip(rows, texts, strict=True):
        assert (r["n_words"], r["n_hit"], ",".join(r["items"])) == brute_hits(t, items), t
        assert r["contaminated"] == (r["n_hit"] > 0) and r["n_items"] == len(r["items"])
    assert decontam.contamination(odd_docs, bench).count() == odd_docs.count()
    assert decontam.contamination(no_docs, bench).count() == 0
    assert decontam.contamination(docs, bench.limit(0)).where("contaminated").count() == 0




def test_fingerprints_alone_find_near_copies(spark, monkeypatch):
    """Without a shared key of minima the deletion variants of the fingerprints bring candidates; shingles decide."""
    words = sentence(71, 400).split()
    near, other = list(words), list(words)
    near[200] = "edit"
    for i in range(0, 400, 40):
        other[i] = f"edit{i}"
    texts = [" ".join(words), " ".join(near), " ".join(other), sentence(72, 400)]
    real, keys = simhash.fingerprint, simhash.band_keys
    first = real(texts[0])
    monkeypatch.setattr(simhash, "fingerprint", lambda t, shingle=4: first ^ 0b10010010001 if "edit" in t else real(t, shingle))  # four bits
    monkeypatch.setattr(simhash, "band_keys", lambda own: [k ^ int(own.sum()) for k in keys(own)])
    assert kept_places(spark, texts) == [0, 2, 3]  # 0.78 by shingles keeps 2, four bits or not


def test_small_links_need_no_round(spark, monkeypatch):
    """Links that a task holds are contracted, not starred; both ways give the same roots."""
    from tallyloom.llm import components as parts

    links = spark.createDataFrame([(i, i + 1) for i in range(300) if i % 50] + [(900, 3), (7, 7)], "a long, b long").repartition(6)
    starred = []
    star = parts._star
    monkeypatch.setattr(parts, "_star", lambda links, large: (starred.append(large), star(links, large))[1])
    quick = sorted(map(tuple, components(links).collect()))
    assert not starred
    monkeypatch.setattr(parts, "HELD", 20)
    assert sorted(map(tuple, components(links).collect())) == quick and starred
