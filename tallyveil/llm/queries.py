"""The registered queries of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import clustering, conversation, decontaminate, exact_dedup, jaccard_join, language_id, line_dedup, mixing, pii, quality, secret_ledger, toxicity, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from rows that aren't held out; edge cases as in `language_id.predict`."""
    return language_id.identified(_table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents; edge cases as in `exact_dedup.exact_groups`."""
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op3_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document through a new ledger; edge cases as in `secret_ledger.scan_versions`."""
    return secret_ledger.scan_documents(_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that are on many sites; edge cases as in `line_dedup.line_spread`."""
    return line_dedup.line_spread(_table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked documents by 3-word shingles at 0.9; edge cases as in `jaccard_join.near_copies`."""
    return jaccard_join.near_copies(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document; edge cases as in `pii.personal_data`."""
    return pii.personal_data_digest(_table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document; edge cases as in `mixing.mixture`."""
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page; edge cases as in `url_filter.judged`."""
    return url_filter.judged(_table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages of every document; edge cases as in `decontaminate.contamination`."""
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from rows that aren't held out; edge cases as in `quality.scored`."""
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation; edge cases as in `conversation.repair_audit`."""
    return conversation.repair_audit(_table(spark, sf_dir, "conversations"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from rows that aren't held out; edge cases as in `toxicity.scored`."""
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector; edge cases as in `clustering.clustered`."""
    return clustering.clustered(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language_id, op2_exact_dedup, op3_secret_ledger, op4_line_dedup, op5_jaccard_join, op6_personal_data, op7_source_mixing, op8_url_filter, op9_decontamination, op10_quality, op11_conversation_repair, op12_toxicity, op13_centroids)}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": exact_dedup.OP2_SQL,
        "op3_secret_ledger": secret_ledger.op3_sql(),
        "op4_line_dedup": line_dedup.OP4_SQL,
        "op5_jaccard_join": jaccard_join.OP5_SQL,
        "op7_source_mixing": mixing.OP7_SQL,
        "op8_url_filter": url_filter.op8_sql(),
        "op9_decontamination": decontaminate.OP9_SQL,
        "op11_conversation_repair": conversation.op11_sql(),
        "op13_centroids": clustering.op13_sql(),
    }
