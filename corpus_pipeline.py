"""A corpus pipeline: each stage gets what its predecessor wrote and returns documents.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir). ``run``
applies them to the ``documents`` table, each stage written as Parquet to the
shared folder and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewright.llm import decontaminate, language_id, mixing, near_dup, quality_rules
from pricewright.staging import staged

#: An Arrow batch is held whole, by Spark and by the Python worker, beside a heap that earlier stages have filled.
_BATCH, _SPARKS_OWN, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20), str(8 << 20)


def small_batches(spark: SparkSession) -> None:
    """Batches of ``BATCH_BYTES`` for Python stages, unless the session asks for a size of its own."""
    if spark.conf.get(_BATCH, _SPARKS_OWN).rstrip("b") == _SPARKS_OWN:
        spark.conf.set(_BATCH, BATCH_BYTES)


def passing_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.passing(docs)


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a language that a third of their words agree on, go."""
    small_batches(spark)
    return language_id.in_known_language(docs, least=0.35)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the smallest doc_id stays."""
    small_batches(spark)
    return near_dup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that mostly consist of them go."""
    small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove_spans(docs, benchmark).withColumn("n_chars", F.length("text").cast("long"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, target and the words taken of each."""
    small_batches(spark)
    return mixing.mixed(docs)


STAGES = [
    ("quality_rules", passing_rules),
    ("language_id", in_a_language),
    ("near_dup", one_per_group),
    ("decontaminate", without_benchmark),
    ("mixing", mixed),
]

#: SQL can express neither the trained models nor the sampling; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
