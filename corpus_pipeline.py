"""Corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage is written as Parquet and reread before the next; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebars.llm.decontamination import without_leaks
from tidebars.llm.packing import pack_documents
from tidebars.llm.simhash_gray import one_of_each
from tidebars.llm.substring_dedup import without_repeats
from tidebars.llm.tokens import default_tokenizer
from tidebars.llm.toxicity import without_toxic
from tidebars.session import stage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, predicts toxic go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id", "text", threshold=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, that of the least id."""
    return one_of_each(docs, "doc_id", "text", shingle=3, bits=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that occur again are cut and ``n_chars`` follows; every document stays."""
    kind = docs.schema["n_chars"].dataType
    return without_repeats(docs, "text", 35).withColumn("n_chars", F.length("text").cast(kind))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark`` go."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "doc_id", "text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 ids."""
    return pack_documents(docs, default_tokenizer(), "doc_id", "text", size=4096, end=2).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_leaks),
    ("packing", packing),
]

#: SQL has neither the fingerprints nor the trained model nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, work in STAGES:
        docs = stage(work(spark, docs, sf_dir))
    return docs
