"""The queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import embedding_join, exact_dedup, jaccard_join, licenses, mixing, packing, quality, suffix_dedup, toxicity, url_rules
from .common import table


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op5_license_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices that are wrapped, inside a line or part of a longer text, which op5_license_scan's units do not show."""
    return licenses.license_passages(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the examples is indexed."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), chance=None).drop("evidence")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.query(spark, table(spark, sf_dir, "pages"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.embedding_links(table(spark, sf_dir, "embeddings"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_suffix_array_dedup, op2_exact_dedup, op3_mixing, op4_quality, op5_license_scan, op5_license_passages, op6_toxicity, op7_packing, op8_url_filter, op9_embedding_near_dedup, op10_jaccard_join)}
ORACLES = {"op2_exact_dedup": exact_dedup.ORACLE, "op3_mixing": mixing.ORACLE, "op5_license_scan": licenses.ORACLE, "op8_url_filter": url_rules.ORACLE, "op9_embedding_near_dedup": embedding_join.ORACLE}
