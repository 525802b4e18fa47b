"""The operators bound to the driver's tables, and their DuckDB oracles.

Each query applies one operator, with its production parameters, to the
whole of its table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import lm_score as lm
from rivulet.llm.common import held_out, table
from rivulet.llm.exact_dedup import dedup_sql, exact_dedup
from rivulet.llm.hard_negatives import hard_negatives, negatives_sql
from rivulet.llm.html_text import html_text
from rivulet.llm.language_id import fit_language_model, language_id
from rivulet.llm.quality_rules import quality_rules, rules_sql
from rivulet.llm.sentence_pieces import sentence_piece_digests
from rivulet.llm.simhash import simhash_groups
from rivulet.llm.source_mixing import source_mixing
from rivulet.llm.token_alignment import token_alignment
from rivulet.llm.topk_search import topk_search, topk_sql
from rivulet.llm.toxicity import fit_toxicity, toxicity
from rivulet.llm.url_filter import url_filter

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def q_url_filter(spark, sf_dir):
    """URL verdicts of pages: rules, and boosted trees for the rest."""
    return url_filter(table(spark, sf_dir, "pages"))


def q_simhash(spark, sf_dir):
    """SimHash fingerprints and near-duplicate components of documents."""
    return simhash_groups(table(spark, sf_dir, "documents"))


def q_lm_score(spark, sf_dir):
    """Log probabilities of documents under a model of the other folds."""
    docs, held = table(spark, sf_dir, "documents"), held_out("doc_id", 7, 2)
    return lm.score_corpus(docs, ~held, PIECE_MODEL).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
        "score")


def q_language_id(spark, sf_dir):
    """Languages of documents, learned from the documents of the other folds."""
    docs = table(spark, sf_dir, "documents")
    held = held_out("doc_id", 5, 0)
    model = fit_language_model(docs.filter(~held))
    return language_id(docs, model).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score")


def q_toxicity(spark, sf_dir):
    """Toxicity of documents, learned from the labels of the other folds."""
    docs, held = table(spark, sf_dir, "documents"), held_out("doc_id", 5, 0)
    weights = fit_toxicity(docs, table(spark, sf_dir, "labels").filter(~held))
    return toxicity(docs, weights).select(
        "doc_id", held.alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def q_quality_rules(spark, sf_dir):
    """Quality measures and verdicts of documents."""
    return quality_rules(table(spark, sf_dir, "documents"))


def q_sentence_pieces(spark, sf_dir):
    """SentencePiece ids and decoded texts of documents, as digests."""
    return sentence_piece_digests(table(spark, sf_dir, "documents"), PIECE_MODEL)


def q_source_mixing(spark, sf_dir):
    """Documents mixed to target weights of their sources."""
    return source_mixing(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def q_topk_search(spark, sf_dir):
    """The ten nearest sign codes of every hundredth embedding."""
    return topk_search(table(spark, sf_dir, "embeddings"))


def q_html_text(spark, sf_dir):
    """Main text of pages."""
    return html_text(table(spark, sf_dir, "pages"))


def q_exact_dedup(spark, sf_dir):
    """Exact duplicates among documents, and the row of each group that stays."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def q_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth embedding's positives."""
    return hard_negatives(table(spark, sf_dir, "embeddings"))


def q_token_alignment(spark, sf_dir):
    """Byte-level BPE tokens of documents aligned with SentencePiece tokens."""
    return token_alignment(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_MODEL)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": q_url_filter,
    "op2_simhash": q_simhash,
    "op3_lm_score": q_lm_score,
    "op4_language_id": q_language_id,
    "op5_toxicity": q_toxicity,
    "op6_quality_rules": q_quality_rules,
    "op7_sentence_pieces": q_sentence_pieces,
    "op8_source_mixing": q_source_mixing,
    "op9_topk_search": q_topk_search,
    "op10_html_text": q_html_text,
    "op11_exact_dedup": q_exact_dedup,
    "op12_hard_negatives": q_hard_negatives,
    "op13_token_alignment": q_token_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op6_quality_rules": rules_sql(), "op9_topk_search": topk_sql(),
    "op11_exact_dedup": dedup_sql(), "op12_hard_negatives": negatives_sql(),
}
