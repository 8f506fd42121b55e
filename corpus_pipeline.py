"""Corpus pipeline: each stage takes the documents that the one before it kept
and calls one operator of ``ledgerline.llm``. A stage's result is written as
Parquet and read back as the next one's documents, so a lost executor costs
tasks of one stage, not the pipeline.

Null and empty texts score below the quality threshold and go in the first
stage; a null doc_id is kept like any other. Of rows that share the smallest
doc_id of a near-duplicate group one stays (see simhash.keep_first). Extra
columns pass through to the last stage, which returns the encoded corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, pieces, quality_model, simhash, store, substring
from ledgerline.llm.queries import PIECE_MODEL, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    weights = quality_model.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return quality_model.keep_good(docs, weights, 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: 3-word shingles, 2 bits."""
    return simhash.keep_first(docs, shingle=3, max_bits=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 20 words and more that start earlier; a
    document of which nothing is left goes."""
    cut = substring.remove_repeats(docs, window=20)
    return with_length(cut).where(has_word("text"))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of the benchmark; a document of which more than
    half is benchmark text goes."""
    clean = decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"), window=10, max_hit_share=0.5)
    return with_length(clean).where(has_word("text"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, ids, scores, alternatives): the best segmentation of
    each text, the scores of the four best, and where these differ."""
    out = pieces.encode(docs, pieces.fitted(docs, PIECE_MODEL), n=4)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "scores", "alternatives")


def has_word(column: str):
    return F.col(column).rlike(r"[^\x20\x09-\x0D]")


def with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("SentencePiece encoding", encoded),
]

ORACLE_SQL = None  # models, fingerprints and segmentations are beyond SQL; tests/llm checks against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store.written(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return docs
