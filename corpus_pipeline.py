"""Cleaning a text corpus: five stages over ``documents``, each written and read again.

Every stage takes all that its predecessor kept and judges it on that input alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import bpe, decontam, langid, minhash, substrings
from marketlake.llm.common import held_out, materialise, table
from marketlake.llm.queries import ranks_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; rejected ones go."""
    found = langid.identify(docs, langid.learn(docs, where=~held_out()))
    return found.filter("NOT rejected").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-word shingle sets are 80 % similar or more."""
    return minhash.keep_first(docs, words=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated 20-word windows, the first copy kept."""
    return substrings.clean(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verbatim window of a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents with their token counts and the digests of encoding and decoding."""
    return bpe.round_trip(docs, ranks_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontaminated),
    ("byte_bpe", tokens),
]

#: Compression, hashing and merges by rank cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
