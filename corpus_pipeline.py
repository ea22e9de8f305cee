"""A corpus pipeline of five training-data operators, each over all that the last one kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import decontam, mixing, near, private, toxicity
from basketlens.llm.store import bounded_batches, shipped, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go; it learns from the documents given."""
    bounded_batches(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by similarity the one with the least doc_id stays."""
    bounded_batches(spark)
    return near.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    bounded_batches(spark)
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the text; no document goes."""
    bounded_batches(spark)
    return private.redacted(docs, private.train(docs))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often and with how many words each document enters the mix; 0 for those left out."""
    mixed = mixing.mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixed.withColumn("repeats", F.col("repeats").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("mixing", mixed_sources),
]

#: The classifier chain and the tagger are learned models, which SQL cannot state.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = shipped(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
