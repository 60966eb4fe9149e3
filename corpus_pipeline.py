"""A corpus cleaned and mixed in five stages, each written as Parquet and read again as the next one's input.

Toxic documents go; of each group of near duplicates (five-word shingles,
similarity of 0.8 or more) the smallest id stays; documents that hold a
benchmark item go; secrets are masked in their texts; the sources of what is
left are mixed to target weights.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.llm.mixing import mix_sources
from lakepipe.llm.ngram_join import drop_near_duplicates
from lakepipe.llm.secret_scan import redact_secrets, train
from lakepipe.llm.tiling import decontaminate
from lakepipe.llm.toxicity import drop_toxic
from lakepipe.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity classifier rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return drop_toxic(docs, labels, held_out)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram Jaccard join links."""
    return drop_near_duplicates(docs, n=5, threshold=(4, 5))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents of which string tiling finds half or more of a benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; n_chars is that of the masked text."""
    return redact_secrets(docs, train(docs)).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken."""
    return mix_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secrets),
    ("source_mixing", mixing),
]

#: A trained classifier decides in two stages, which SQL cannot express; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    path = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{k}-{name}")
        docs = spark.read.parquet(f"{path}/{k}-{name}")
    return docs
