"""The corpus pipeline: language ID, quality, near-dedup, substring dedup, packing.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; ``run`` writes every
result as Parquet below the shared scratch folder and hands the reread table to the next stage. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, near_dedup, packing, quality, substrings
from tidemark.llm.registry import table
from tidemark.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is rejected."""
    model = language.fit_documents(table(spark, sf_dir, "documents"))
    return language.predict(docs, model).where("not lang_rejected").select(*COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier scores below its threshold."""
    model = quality.fit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.predict(docs, model).where("predicted = 1").select(*COLUMNS)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, keep the document with the smallest id."""
    return near_dedup.representatives(docs).select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that stand more than once; a text that loses none stays as it is."""
    got = substrings.dedup(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return got.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences, in the mixture of its sources."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", keep_known_language),
    ("quality_classifier", keep_quality),
    ("near_dedup", keep_one_of_each_class),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack),
]

#: SQL expresses none of the trained, sketched or tokenizing stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
