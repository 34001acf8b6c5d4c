"""Retrieval of text chunks for a table of questions.

Words: every chunk's words meet the questions' words in an inverted index, one row per word
and chunk, and a chunk keeps the numbers of the words it shares with any question.  Vectors:
questions are taken in blocks of a fixed size, and a block is scored against all chunks
where they lie.  A task passes on the best ``k`` chunks of each question only.  Texts take
part in the first step, before any shuffle, and again for the hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.scalars import words
from tallyloom.session import stored

# Fixed values of the retrieval setting.
VECTOR_WEIGHT = 0.7
KEYWORD_WEIGHT = 0.3
THRESHOLD = 0.3
TOP_K = 5

BLOCK = 256  # questions scored in one pass over the chunks
AT_ONCE = 1000  # chunks scored at once against a block
_HITS = "question_id long, chunk_id long, vector_score double, keyword_score double, score double"


def _half_up(x: np.ndarray) -> np.ndarray:
    """Six digits, halves away from zero, as SQL rounds."""
    return np.sign(x) * np.floor(np.abs(x) * 1e6 + 0.5) / 1e6


def _unit(vectors: list, size: int) -> np.ndarray:
    """Rows of length one; zero for a vector that is missing, of another size, zero, or has a missing component."""
    out = np.zeros((len(vectors), size))
    for i, v in enumerate(vectors):
        if v is not None and len(v) == size and None not in v:
            out[i] = v
    length = np.sqrt((out**2).sum(axis=1, keepdims=True))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where((length > 0) & np.isfinite(length), out / length, 0.0)


def _posted(chunks: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(chunk_id, found)``: the numbers of the questions' words that each chunk holds."""
    held = chunks.select("chunk_id", F.explode(words("text")).alias("word"))
    return held.join(vocabulary, "word").groupBy("chunk_id").agg(F.collect_set("number").alias("found"))


def hybrid_topk(
    chunks: DataFrame,
    vectors: DataFrame,
    questions: DataFrame,
    k: int = TOP_K,
    threshold: float = THRESHOLD,
    vector_weight: float = VECTOR_WEIGHT,
    keyword_weight: float = KEYWORD_WEIGHT,
    block: int = BLOCK,
) -> DataFrame:
    """The ``k`` best chunks of every question: ``question_id, chunk_id, vector_score, keyword_score, score``.

    ``chunks`` holds ``(chunk_id, text)``, ``vectors`` ``(chunk_id, vector)`` and ``questions``
    ``(question_id, text, vector)``; ids are unique whole numbers, rows without one take no part.  The
    keyword score is the share of the question's different words that the chunk holds, the
    vector score the cosine; without a vector on either side it is 0.  Ties go to the
    smaller chunk.  Hits below ``threshold`` are left out.
    """
    spark = chunks.sparkSession
    chunks = chunks.where("chunk_id IS NOT NULL")
    asked = stored(questions.where("question_id IS NOT NULL").select("question_id", words("text").alias("words"), "vector"), "questions")
    last = None
    hits = spark.createDataFrame([], _HITS)
    while True:
        rest = asked if last is None else asked.where(F.col("question_id") > last)
        batch = rest.orderBy("question_id").limit(block).collect()
        if not batch:
            break
        last = batch[-1]["question_id"]
        numbers = {w: i for i, w in enumerate(sorted({w for q in batch for w in q["words"] or ()}))}
        vocabulary = spark.createDataFrame(list(numbers.items()), "word string, number int")
        scored = chunks.select("chunk_id").join(vectors, "chunk_id", "left").join(_posted(chunks, vocabulary), "chunk_id", "left")
        score = _scorer(batch, numbers, k, (vector_weight, keyword_weight))
        hits = hits.unionByName(scored.mapInArrow(score, _HITS))
    best = F.row_number().over(Window.partitionBy("question_id").orderBy(F.desc("score"), "chunk_id"))
    ranked = hits.withColumn("_rank", best).where(F.col("_rank") <= k).drop("_rank")
    return ranked.where(F.col("score") >= threshold)


def _scorer(batch: list, numbers: dict[str, int], k: int, weights: tuple[float, float]):
    """The scores of a block of questions, which holds at most ``BLOCK`` of them, against the chunks of a task."""
    ids = np.array([q["question_id"] for q in batch], np.int64)
    size = max((len(q["vector"]) for q in batch if q["vector"] is not None), default=0)
    vectors = _unit([q["vector"] for q in batch], size)
    asks = np.zeros((len(numbers) + 1, len(batch)), np.float32)
    for j, q in enumerate(batch):
        asks[np.array([numbers[w] for w in q["words"] or ()], np.int64), j] = 1
    lengths = asks.sum(axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, AT_ONCE):
                part = whole.slice(start, AT_ONCE)
                chunk = part.column("chunk_id").to_numpy().astype(np.int64)
                cosine = _half_up(_unit(part.column("vector").to_pylist(), size) @ vectors.T)
                held = np.zeros((len(chunk), len(numbers) + 1), np.float32)
                for i, found in enumerate(part.column("found").to_pylist()):
                    held[i, np.array(found or (), np.int64)] = 1
                keyword = _half_up((held @ asks).astype(np.float64) / np.maximum(lengths, 1))
                score = _half_up(cosine * weights[0] + keyword * weights[1])
                # Chunks in the order of their ids, so that equal scores stay in it.
                rows = np.argsort(chunk, kind="stable")
                best = rows[np.argsort(-score[rows], axis=0, kind="stable")[:k]]
                column = np.broadcast_to(np.arange(len(ids)), best.shape)
                values = [ids[column], chunk[best], cosine[best, column], keyword[best, column], score[best, column]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v.ravel()) for v in values], ["question_id", "chunk_id", "vector_score", "keyword_score", "score"]
                )

    return run


def concat_context(hits: DataFrame, chunks: DataFrame, k: int = TOP_K) -> DataFrame:
    """``(question_id, context)``: the texts of each question's best ``k`` hits, best first, each followed by a blank line.

    Hits without a text add nothing.  Only the chunks that were hit are read into the join.
    """
    texts = hits.join(chunks.select("chunk_id", "text"), "chunk_id")
    ranked = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "chunk_id", "text"))), 1, k)
    parts = F.transform(ranked, lambda hit: F.concat(hit["text"], F.lit("\r\n\r\n")))
    return texts.groupBy("question_id").agg(F.array_join(parts, "").alias("context"))
