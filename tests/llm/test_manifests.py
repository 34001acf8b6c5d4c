"""The Merkle manifest, the tokenizer alignment and the archives against brute force."""

import base64
import hashlib
import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_samples import sentence
from tallyloom.llm import alignment, merkle, queries, warc

# 11 manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves):
    """The root and, per leaf, the digests before and after it in the runs on its way up."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for path, i in zip(paths, at, strict=True):
            run = i - i % 3
            path.append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
        at = [i // 3 for i in at]
        level = [digest(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return level[0], paths


def manifest(rows, columns, key="doc_id", source="source"):
    """``(key, leaf, subroot, root, path)`` of all rows."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[source]].append((r[key] is not None, r[key] or 0, digest(*(field(r[c]) for c in columns))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {s: tree([leaf for *_, leaf in sorted(groups[s])]) for s in names}
    root, above = tree([made[s][0] for s in names])
    out = []
    for s, up in zip(names, above, strict=True):
        for (known, k, leaf), path in zip(sorted(groups[s]), made[s][1], strict=True):
            out.append((k if known else None, leaf, made[s][0], root, path + up))
    return sorted(out, key=str)


def shown(found):
    return sorted(((r[0], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]]) for r in found.collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 3, 6, 8])
def test_layout_is_recursive(levels):
    places = merkle.addresses(levels)
    assert sorted(np.concatenate(places)) == list(range((3**levels - 1) // 2)) and [len(p) for p in places] == [3**d for d in range(levels)]
    above = levels // 2
    if above:
        size = (3 ** (levels - above) - 1) // 2
        for i, start in enumerate(places[above]):  # every lower half lies in one piece and is laid out alike
            own = [p[i * 3**d : (i + 1) * 3**d] - start for d, p in enumerate(places[above:])]
            assert all((a == b).all() for a, b in zip(own, merkle.addresses(levels - above), strict=True)) and max(map(np.max, own)) == size - 1


@pytest.mark.parametrize("block", [1, 2, 7])
def test_manifest_against_brute_force(spark, odd_docs, block):
    docs = odd_docs.withColumns({"n": F.lit(5), "place": F.col("doc_id"), "digest": F.lit("x"), "tree": F.lit(None).cast("string")})
    columns = ["doc_id", "source", "text", "size"]
    for n, groups in {1: ((40, 3),), 2: ((1, 1), (100, 28)), 7: ((2, 1),)}[block]:
        made = spark.range(n).select(
            F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % groups).alias("source"), F.lit("é t").alias("text"), F.lit(None).cast("int").alias("size")
        )
        assert shown(merkle.manifest(made, columns, block=block)) == manifest(made.collect(), columns)
    found = merkle.manifest(docs, columns, carry=["doc_id", "place", "digest", "n", "tree"], block=block)
    assert shown(found) == manifest(docs.collect(), columns) and found.columns[:5] == ["doc_id", "place", "digest", "n", "tree"]
    assert found.where("NOT doc_id <=> place OR digest != 'x' OR n != 5 OR tree IS NOT NULL").isEmpty()


def test_manifest_tells_tampering_and_takes_no_rows(spark, odd_docs, no_docs):
    columns = ["doc_id", "source", "text"]
    assert merkle.manifest(no_docs, columns).count() == 0
    copy = merkle.leaf(F.col("doc_id"), F.col("source"), F.replace("text", F.lit("\n"), F.lit("")))
    found = merkle.manifest(odd_docs.withColumn("copy", copy), columns, carry=["doc_id", "text", "copy"])
    for r in found.withColumns({"up": merkle.folded(F.col("path"), F.col("copy")), "own": merkle.folded(F.col("path"), F.col("leaf"))}).collect():
        assert r["own"] == r["root"] and (r["up"] == r["root"]) == ("\n" not in (r["text"] or ""))


def test_manifest_query_tampers_as_stated(spark):
    rows = queries.QUERIES["op11_merkle_manifest"](spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in rows:
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and "\n" in (texts[r["doc_id"]] or "")
        assert r["verified"] == (not changed)
    assert {r["verified"] for r in rows} == {True, False}


# 12 alignment


def aligned(rows):
    """Per row the figures and the groups' text, worked out span by span."""
    library = Tokenizer.from_file(alignment.BYTE_BPE)
    library.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)
    with open(alignment.BYTE_BPE, "rb") as a, open(alignment.PIECE_BPE, "rb") as b:
        bytes_of = [side.bytes_of for side in (alignment.byte_bpe(a.read()), alignment.piece_bpe(b.read()))]

    def spans(ids, own):
        at = 0
        for i in ids:
            yield at, at + len(own[i]), i
            at += len(own[i])

    found, counts = [], Counter()
    for text in rows:
        a, b = (library.encode(" " + text, add_special_tokens=False).ids, model.encode(text)) if text else ([], [])
        want = (" " + (text or "")).encode()
        if not text or any(b"".join(own[i] for i in ids) != want for ids, own in zip((a, b), bytes_of, strict=True)):
            found.append(None)
            continue
        a, b = list(spans(a, bytes_of[0])), list(spans(b, bytes_of[1]))
        pairs, start = [], 0
        for lo, hi, i in a:
            while b[start][1] <= lo:
                start += 1
            j = start
            while j < len(b) and b[j][0] < hi:
                pairs.append((i, b[j][2]))
                j += 1
        ends = sorted({hi for _, hi, _ in a} & {hi for _, hi, _ in b})
        sides = [[[str(i) for lo, hi, i in side if at < hi <= end] for at, end in zip([0, *ends], ends, strict=False)] for side in (a, b)]
        groups = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in zip(*sides, strict=True))
        counts.update(pairs)
        found.append((len(a), len(b), len(ends), pairs, groups))
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    for f in found:
        if f is None:
            yield (0, 0, 0, 0, 0, 0, "")
        else:
            a, b, n, pairs, groups = f
            yield a, b, n, len(pairs), sum(counts[p] == top[p[1]] for p in pairs), sum(counts[p] for p in pairs), groups


ODD_TEXTS = [
    "a\x00b ▁ x",
    "plain ▁ letter that one side reads as a space",
    " ",
    "<|endoftext|> <s> </s> <unk> <0x41> ▁",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "日本語 テキスト 🙂🙂  \n\n\t x",
    "x" * 3000 + " " * 6000 + "y",
    "ꟊ 𞤀 ܀ new letters",
    "repeat repeat",
    "repeat repeat",
]


@pytest.mark.parametrize("at_most", [0, 7, alignment.PLACED])
def test_alignment_against_brute_force(spark, odd_docs, at_most):
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string")
    docs = odd_docs.withColumns({"at": F.lit("u"), "own": F.lit(7), "rare": F.lit(1.5), "n_a": F.lit("gone")}).unionByName(extra, allowMissingColumns=True)
    found = alignment.align(docs, at_most=at_most)
    got = sorted(((r["doc_id"], *(r[c] for c in alignment.OUTPUTS)) for r in found.collect()), key=str)
    rows = docs.collect()
    want = sorted(((r["doc_id"], *f) for r, f in zip(rows, aligned([r["text"] for r in rows]), strict=True)), key=str)
    assert got == want
    assert {c for c in docs.columns if c != "n_a"} <= set(found.columns) and found.where("at = 'u' AND own = 7 AND rare = 1.5").count() == odd_docs.count()


def test_alignment_takes_no_rows(no_docs):
    assert alignment.align(no_docs).count() == 0


def test_ranks_give_the_ids_of_the_file():
    """Every settled letter in the places that decide how a text is cut."""
    with open(alignment.BYTE_BPE, "rb") as f:
        content = f.read()
    library = Tokenizer.from_str(json.loads(content) and content.decode())
    library.encode_special_tokens = True
    encode = alignment.byte_bpe(content).encode
    letters = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and alignment.SETTLED.fullmatch(chr(i))]
    assert len(letters) > 30000
    picked = random.Random(3)
    texts = ["".join(f"a{c}1 {c}b{c}{c} " for c in letters[i : i + 200]) for i in range(0, len(letters), 200)]
    texts += ["".join(picked.choices(letters[:400] + letters[::301] + [" ", "\n", "'s"], k=300)) for _ in range(200)]
    for text in texts:
        assert list(encode([text])[0]) == library.encode(" " + text, add_special_tokens=False).ids


# 13 archives


def odd_pages(spark):
    rows = [
        (1, "http://www.b.example/x?q=1#top", "<p>one</p>"),
        (2, "https://a.example", "<p>one</p>"),
        (3, "https://A.example:8080/", "two\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"),
        (4, None, ""),
        (5, "no address", None),
        (6, "http://a.example/\r\nInjected: yes", "é 日本 \x00 end\r\n"),
        (7, "http://b.example/x", "<p>one</p>"),
        (7, "http://b.example/x", "<p>one</p>"),
        (None, "http://b.example/x", "<p>one</p>"),
        (None, None, "alone"),
        (8, "http://b.example/long", "long " * 200_000),
        (9, "http://b.example/long", "\n"),
    ]
    rows += [(100 + i, f"http://h{i % 7}.example/p", sentence(i % 11, 5)) for i in range(120)]
    return spark.createDataFrame([(*r, "k", 3) for r in rows], "page_id long, url string, html string, _key string, run int")


def base32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@pytest.mark.parametrize("least", [0, 8])
@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archive_round_trip(spark, least, compression):
    pages = odd_pages(spark)
    found = warc.records(spark, warc.archive(pages, least=least, compression=compression)).collect()
    rows = pages.collect()
    payloads = [(r["html"] or "").encode() for r in rows]
    last = {}
    for r, p in zip(rows, payloads, strict=True):
        last[p] = max(last.get(p, (False, 0)), (r["page_id"] is not None, r["page_id"] or 0))
    want = []
    for r, p in zip(rows, payloads, strict=True):
        again = len(p) >= least and last[p] != (r["page_id"] is not None, r["page_id"] or 0)
        url = r["url"] and r["url"].replace("\r", "%0D").replace("\n", "%0A")
        want.append((r["page_id"], "revisit" if again else "response", url, len(p), base32(p), last[p][1] if again else None, None if again else p.decode(), True))
    columns = ("page_id", "record_type", "url", "payload_bytes", "payload_digest", "refers_to", "payload", "whole")
    assert sorted((tuple(r[c] for c in columns) for r in found), key=str) == sorted(want, key=str)


def test_archive_is_read_in_pieces(spark):
    """A file cut into splits at any place gives the same records."""
    pages = odd_pages(spark).coalesce(1)
    folder = warc.archive(pages, compression="none")
    whole = sorted(str(r) for r in warc.records(spark, folder).drop("archive").collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3001")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        cut = warc.records(spark, folder).drop("archive")
        assert cut.rdd.getNumPartitions() > 50 and sorted(str(r) for r in cut.collect()) == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_archive_takes_no_rows(spark):
    found = warc.histories(warc.records(spark, warc.archive(odd_pages(spark).limit(0))))
    assert found.count() == 0 and "place" in found.columns


def test_loser_tree_merges():
    picked = random.Random(5)
    for k in range(9):
        runs = [sorted(picked.choices(range(20), k=picked.choice([0, 1, 3, 30]))) for _ in range(k)]
        heads, out = [0] * k, []
        for run in warc.loser_tree(runs):
            out.append((runs[run][heads[run]], run))
            heads[run] += 1
        assert out == sorted((x, i) for i, run in enumerate(runs) for x in run)


@pytest.mark.parametrize("per_range", [3, 40, 1000])
def test_histories_are_in_one_order(spark, per_range):
    pages = odd_pages(spark).unionByName(odd_pages(spark).where("page_id = 9")).repartition(5)
    found = warc.histories(warc.records(spark, warc.archive(pages)), per_range=per_range)
    rows = sorted(found.collect(), key=lambda r: r["place"])
    assert [r["place"] for r in rows] == list(range(pages.count()))
    keys = [(r["url_key"].encode(), r["captured"], r["page_id"] is not None, r["page_id"] or 0) for r in rows]
    assert keys == sorted(keys)
    by = {r["page_id"]: r["url_key"] for r in rows}
    assert by[1] == "example,b)/x?q=1" and by[2] == by[3] == "example,a)/" and by[5] == ""
