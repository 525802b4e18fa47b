"""Corpus pipeline: raw documents to token digests of a mixed, clean corpus.

Each stage calls one operator of ``rivulet.llm`` on all rows that its
predecessor kept; stages are written as Parquet and reread in between, so a
lost executor or a restart costs one stage. Defined results: an empty table
stays empty through all stages; null and empty texts are rejected by the
quality rules; extra columns of documents are carried as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm.common import held_out, table
from rivulet.llm.language_id import fit_language_model, keep_languages
from rivulet.llm.quality_rules import keep_quality
from rivulet.llm.queries import PIECE_MODEL
from rivulet.llm.sentence_pieces import sentence_piece_digests
from rivulet.llm.simhash import keep_one
from rivulet.llm.source_mixing import mix
from rivulet.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_quality(docs)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language. The model is learned from the labelled
    documents of this stage's input, but for the held-out fold."""
    return keep_languages(docs, fit_language_model(docs.filter(~held_out("doc_id", 5, 0))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest id."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: each document as often as it is taken."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of each document of the mix."""
    return sentence_piece_digests(docs, PIECE_MODEL)


STAGES = [
    ("quality_rules", quality),
    ("language_id", languages),
    ("simhash_dedup", near_duplicates),
    ("source_mixing", mixing),
    ("sentence_pieces", tokens),
]

# Trained models, SimHash and SentencePiece have no SQL form: run() is tested
# against a brute-force version in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's output is a table under
    the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
