"""The corpus pipeline: five stages over ``documents``, each written and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns what it keeps.  All but the last keep the columns of ``documents``.
The SQL of a result is None: language models, MinHash candidates and seeded
selection have no SQL; tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterlens.llm import decontaminate, language, mixing, near_dedup, secrets
from quarterlens.llm.common import materialize, table

ORACLE_SQL = None


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language that was learned, go."""
    return language.known_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest doc_id."""
    return near_dedup.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item within its error budget go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` follows the text."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, sources by target weight."""
    return mixing.mix_sources(docs)


STAGES = [
    ("language", keep_known_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
