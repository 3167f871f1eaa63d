"""A training corpus from raw documents: each stage takes what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm import decontaminate, language, mixing, secrets, simhash_dedup
from tallywright.llm.common import WRITTEN, discard, materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or with no language ahead of the others, go."""
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: five-word shingles, a similarity of 0.8."""
    return simhash_dedup.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows the text."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with `copies`, how often."""
    return mixing.mixed_rows(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("secrets", redact_secrets),
    ("mix", mix_sources),
]

#: Language identification and SimHash linking are beyond SQL: tests compare run() with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    since = len(WRITTEN)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(spark, since, keep=1)  # what this stage has read and left behind
    return docs
