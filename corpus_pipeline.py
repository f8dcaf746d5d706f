"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rentlake.llm import language_id, mixing, ngram_join, packing, secrets
from rentlake.llm.registry import tokenizer_path
from rentlake.llm.scratch import Scratch, documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the rejected ones go."""
    return language_id.identified(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies: 0.8 or more of their five-word shingles in common."""
    return ngram_join.representatives(docs, ngram_join.NEAR_COPIES)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets and linked parts of credentials masked."""
    return secrets.redacted(docs)


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", to_target_weights),
    ("packing", packed),
]

# Language models and draws by hash have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage_{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
