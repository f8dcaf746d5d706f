"""The queries over the sample tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rentlake.llm import (
    fill_middle,
    fingerprints,
    language_id,
    lexical_search,
    mixing,
    ngram_join,
    oracles,
    packing,
    quality_rules,
    secrets,
    sharding,
    suffix_dedup,
    toxicity,
    unit_dedup,
)
from rentlake.llm.scratch import benchmark, documents, labels


def tokenizer_path() -> str:
    """The vocabulary that the queries pack with; operators take its path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.repeated_units(documents(spark, sf_dir)).drop("row")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir)).drop("found", "text_key")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_components(documents(spark, sf_dir))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), labels(spark, sf_dir))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(documents(spark, sf_dir)).drop("spans")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path())


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir), labels(spark, sf_dir))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(documents(spark, sf_dir)).drop("changed", "changed_to")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_secret_scan,
        op3_ngram_jaccard_join,
        op4_language_id,
        op5_toxicity,
        op6_suffix_dedup,
        op7_packing,
        op8_mixing,
        op9_quality_rules,
        op10_fingerprints,
        op11_sharding,
        op12_lexical_search,
        op13_fill_in_middle,
    )
}

ORACLES: dict[str, str] = oracles.ORACLES
