"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

``run(spark, sf_dir)`` keeps good and harmless documents, one of each near-duplicate group, masks
personal data and packs what is left into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import near_dedup, packing, pii, quality_model, toxicity
from orderloom.llm.common import prepare, table
from orderloom.session import scratch_path


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    prepare(spark)
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_model.scorer(spark, model)(docs["text"]) >= quality_model.THRESHOLD)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    prepare(spark)
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.scorer(spark, machine)(docs["text"]) < toxicity.THRESHOLD)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group."""
    prepare(spark)
    return near_dedup.distinct_documents(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in their texts."""
    return pii.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences. Four stages have filled the executors' heaps by now, so the workers are lean."""
    return packing.digest(packing.pack(docs, plain_names=False, lean=True))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_model", good),
    ("toxicity", harmless),
    ("near_dedup", unique),
    ("pii", private),
    ("packing", packed),
]

# SQL can express neither learnt models nor tokens, so the whole run is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, with a written table between them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
