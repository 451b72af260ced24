"""A training corpus from documents, in five stages; each reads what the one before it has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyveil.llm import decontaminate, exact_dedup, jaccard_join, mixing, quality
from tallyveil.llm.scratch import staged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking passes.

    Null texts are judged as empty ones; without labels all pass. Every stage
    gives no rows for an empty table, keeps all columns whatever their names,
    and reads null ids, repeated rows and very long texts as its operator says.
    """
    return quality.good_documents(docs, _table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every text, that with the largest id; null and empty texts are one group, repeated rows leave one."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of every group that links of five-word shingles at a similarity of 0.8 join; texts without words stay."""
    return jaccard_join.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark; null and empty texts stay."""
    return decontaminate.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words from, with mix_words: how many, repeats counted. Texts without words are not taken; a null source is the last source."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to documents."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The fitted ranking has no SQL form; tests/llm/test_pipeline.py holds run() against plain loops.
ORACLE_SQL = None
