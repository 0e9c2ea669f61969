"""From documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm import contamination, packing, secrets, simhash, weaklabel
from panelweave.llm.common import written
from panelweave.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    return weaklabel.without_rejected(docs)


def simhash_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates stays: that with the smallest id."""
    return simhash.one_of_each(docs, shingle=3, distance=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which ten consecutive words of a benchmark item, or a whole shorter item, occur go."""
    return contamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret spans are replaced by a mark; n_chars follows the text."""
    return secrets.redacted(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, cut and packed into sequences of 2048 tokens; one row per piece."""
    return packing.pack_documents(docs, tokenizer_path(), 2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_duplicates", simhash_near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

# The classifier's fit, the components and the packing are iterative: no SQL gives the rows.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
