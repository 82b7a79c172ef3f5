"""A training corpus from raw documents: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skuflow.config import scratch_scope
from skuflow.llm import decontamination, jaccard, mixing, quality, secrets
from skuflow.llm.common import table, written

KEEP_SCORE = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model, name="_score").where(f"_score >= {KEEP_SCORE}").drop("_score")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five-word n-grams, similarity 0.8)."""
    return jaccard.deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage stands."""
    hits = decontamination.with_hits(docs, table(spark, sf_dir, "benchmark"), name="_hits")
    return hits.where("size(_hits) = 0").drop("_hits")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each live secret's characters replaced by a mark."""
    return secrets.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words it takes of each (repeats counted)."""
    return mixing.mix(docs, keep=True).where("taken > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("mixing sources", mixing_stage),
]

# The stages learn models and draw by Spark's own hashes, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage wrote for itself goes once its result is written;
    the stages' results stay."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch_scope(spark):
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"), keep=True)
    return docs
