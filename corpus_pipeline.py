"""The corpus pipeline: documents in, mixed and sharded training rows out.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame.  ``run`` writes every stage's rows to the shared folder and reads
them back as the next one's input, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import decontam, mixing, sharding, simhash, toxicity
from tallyloom.session import stored, tune


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, does not call toxic."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, out="_toxic").where("_toxic < 0.5").drop("_toxic")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: candidates by SimHash and by minima, five-word shingles of similarity 0.8 or more."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten consecutive words, and no whole shorter item, with the benchmark."""
    judged = decontam.contamination(docs, _table(spark, sf_dir, "benchmark"))
    return judged.where("NOT contaminated").select(*(f"`{c}`" for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; one that is not taken is absent."""
    return mixing.mixed_rows(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``size``, ``text_crc32``, ``shard`` and ``slot``; copies of a text share a shard."""
    return sharding.shard(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("sharding", assign_shards),
]

# Neither the trained classifier nor the differencing can be said in SQL; tests/llm holds
# the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    tune(spark)
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
