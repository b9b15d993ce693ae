"""The corpus pipeline: quality, exact copies, near copies, mixture, packing. Each stage takes and gives a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from portico.llm import exact_dedup, jaccard_join, mixing, packing, quality
from portico.llm.common import discard, stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one of largest id stays."""
    return exact_dedup.kept_documents(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one of smallest id stays."""
    return jaccard_join.first_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; a document that the mixture takes twice is packed twice."""
    return packing.digest(packing.pack(docs))


STAGES = [("quality", quality_stage), ("exact_dedup", exact_stage), ("jaccard_join", near_stage), ("mixing", mixing_stage), ("packing", packing_stage)]
#: The classifier and the tokens are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
            if k:
                discard(before)
    return docs
