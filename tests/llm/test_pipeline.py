"""The pipeline's stages, one after the other, on a small fixture with known cases."""

import zlib
from collections import Counter

import pytest

import corpus_pipeline
from llm_samples import sentence
from tallyloom.session import stored

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output, planted rows among the documents of the test tables."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first()["text"]
    passage = " ".join(item.split()[:14])
    base = sentence(51, 300)
    near = base.split()
    near[150] = "changed"
    planted = [
        (10**6, sentence(50, 80) + " idiot loser moron " + sentence(52, 20), "en", "new"),
        (10**6 + 1, base, "en", "new"),
        (10**6 + 2, base, "en", "other"),
        (10**6 + 3, " ".join(near), "en", None),
        (10**6 + 4, sentence(53, 60) + " " + passage, "en", "new"),
        (10**6 + 5, sentence(54, 90), None, None),
    ]
    extra = spark.createDataFrame(planted, "doc_id long, text string, lang string, source string")
    current, out = docs.unionByName(extra, allowMissingColumns=True), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, current, SF_DIR), name)
        out.append((name, current, after))
        current = after
    return {name: (before, after) for name, before, after in out}


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_columns(stages):
    for name, (before, after) in stages.items():
        assert after.columns[: len(before.columns)] == before.columns
        assert name == "sharding" or after.columns == before.columns


def test_toxic_rows_go(stages):
    before, after = stages["toxicity"]
    gone = ids(before) - ids(after)
    assert 10**6 in gone and not gone & set(range(10**6 + 1, 10**6 + 6)) and len(gone) < 0.2 * before.count()


def test_one_of_each_group_stays(stages):
    before, after = stages["simhash_near_dedup"]
    left = ids(after)
    assert 10**6 + 1 in left and not left & {10**6 + 2, 10**6 + 3} and 10**6 + 5 in left
    first = {}
    for r in sorted(before.collect(), key=lambda r: r["doc_id"]):
        first.setdefault(r["text"], r["doc_id"])
    assert left <= set(first.values())


def test_benchmark_passages_go(stages):
    before, after = stages["benchmark_decontamination"]
    assert 10**6 + 4 not in ids(after) and {10**6 + 1, 10**6 + 5} <= ids(after) <= ids(before)


def test_mix_repeats_whole_rows(stages):
    before, after = stages["source_mixing"]
    there = Counter(map(tuple, after.collect()))
    once = Counter(map(tuple, before.collect()))
    assert set(there) <= set(once) and max(there.values()) <= 2
    size = lambda rows: sum(n * len((r[1] or "").split()) for r, n in rows.items())
    assert abs(size(there) - 1.5 * size(once)) < 0.1 * size(once)


def test_shards_hold_every_row(stages):
    before, after = stages["sharding"]
    rows = after.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in before.collect())
    slots, shards = {}, {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        shards.setdefault(r["text"], set()).add(r["shard"])
        assert r["text_crc32"] == zlib.crc32(r["text"].encode())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in shards.values())
