"""The registered queries of this part, with the SQL that each must equal where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import alignment, decontam, maxent, merkle, mixing, pii, search, sharding, simhash, substrings, toxicity, urllists, warc
from tallyloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark = tune(spark)
            return fn(lambda table: spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))

        run.__name__, run.__doc__, run.__module__ = name, fn.__doc__, fn.__module__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_pareto_mix", mixing.SQL)
def op1(table):
    """All documents with the words that the mix takes of each."""
    mixed = mixing.mix(table("documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op2_branch_and_bound_search", search.SQL)
def op2(table):
    """The 20 best inner products of every 20th vector against all others."""
    vectors = table("embeddings").select("vec_id", search.quantised("embedding").alias("v"))
    return search.nearest(vectors, vectors.where("vec_id % 20 = 0"))


@query("op3_maxent_scores")
def op3(table):
    """The log probability of all documents under word counts and under the model."""
    return maxent.score(table("documents").select("doc_id", "text"))


@query("op4_temporal_url_lists", urllists.SQL)
def op4(table):
    """Every page judged by the entries active on its fetch day."""
    pages = table("pages").select("page_id", "url")
    judged = urllists.judge(urllists.page_captures(pages), urllists.page_entries(pages))
    days = {c: F.col(c).cast("string") for c in ("fetched_on", "rule_from")}
    return judged.withColumns(days).drop("url")


@query("op5_karmarkar_karp_shards")
def op5(table):
    """All documents in eight shards of nearly equal bytes."""
    sharded = sharding.shard(table("documents").select("doc_id", "text"), carry=["doc_id"])
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op6_personal_data", pii.SQL)
def op6(table):
    """Personal data of all documents as counts, digests and span lists."""
    found = pii.personal_data(table("documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*(k.name for k in pii.KINDS if k.base)))
    return found.select(
        "doc_id",
        *(pii.counted(F.col("pii"), k.name).alias(f"n_{k.name}") for k in pii.KINDS),
        pii.supported(F.col("pii")).alias("n_supported"),
        F.sha2(pii.span_texts(base), 256).alias("base_sha256"),
        pii.span_texts(F.col("pii")).alias("spans"),
    )


@query("op7_toxicity")
def op7(table):
    """All documents with their toxicity."""
    found = toxicity.judged(table("documents").select("doc_id", "text"), table("labels").select("doc_id", "toxic"))
    return found.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


@query("op8_simhash_near_duplicates")
def op8(table):
    """All documents with their fingerprint and the class of near copies that they fall in."""
    found = simhash.near_duplicates(table("documents").select("doc_id", "text"), carry=["doc_id"])
    return found.select("doc_id", simhash.as_hex(F.col("_print")).alias("fingerprint"), "component_id")


@query("op9_substring_dedup", substrings.SQL)
def op9(table):
    """All documents with the words that repeated passages cover, and a digest of what is kept."""
    found = substrings.remove_repeats(table("documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_benchmark_decontamination", decontam.SQL)
def op10(table):
    """All documents with the words and items that they share with the benchmark."""
    judged = decontam.contamination(table("documents").select("doc_id", "text"), table("benchmark").select("item_id", "text"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return judged.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query("op11_merkle_manifest", merkle.SQL)
def op11(table):
    """All documents with their place in the manifest, and whether a copy, some of them tampered with, still leads to its root."""
    docs = table("documents").select(*merkle.COLUMNS)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    copy = merkle.leaf(*(tampered if c == "text" else F.col(c) for c in merkle.COLUMNS))
    found = merkle.manifest(docs.withColumn("copy", copy), carry=["doc_id", "copy"])
    led = found.withColumn("folded_root", merkle.folded(F.col("path"), F.col("copy")))
    return led.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query("op12_tokenizer_alignment")
def op12(table):
    """All documents with the alignment of two tokenizers."""
    docs = table("documents").select("doc_id", "text")
    found = alignment.align(docs, carry=["doc_id"], show=lambda groups: F.sha2(groups, 256))
    return found.withColumnRenamed("groups", "groups_sha256")


@query("op13_warc_histories", warc.SQL)
def op13(table):
    """All pages written to archives, read back and merged into one index."""
    pages = table("pages")
    folder = warc.archive(pages)
    found = warc.histories(warc.records(pages.sparkSession, folder))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "whole", "url_key", "place")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline, one after the other, over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
