"""From raw documents to a training mix, in five stages.

Each stage is a function of (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again as
the next one's docs. All but the last give the columns of ``documents``; the last gives them with ``epoch``, one row for
each time that the mix takes a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorelake.llm import decontaminate, langid, lines, mix, neardup
from scorelake.session import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read as one of the labelled languages."""
    return langid.keep_languages(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand on two sites and long ones in two documents (their first place keeps them)."""
    return lines.cleaned(docs, long_copies=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    return neardup.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the mix of sources takes, once for each epoch."""
    return mix.take_mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
]

#: Language profiles and sketches can't be said in SQL; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
