"""Corpus pipeline: documents in, a mixed training set out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet to the shared checkpoint
folder and read again as the next stage's ``docs``.  All stages but the last
keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontaminate, mixing, pii, rule_ensemble, simhash
from quire.llm.common import shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble rejects go."""
    return rule_ensemble.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal spans become their kind; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of words, mixed to the sources' target weights: one row per block with its doc_ids."""
    return mixing.mixed_texts(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("mixture", mixture)]

# The classifier, SimHash, tiling, EM and the permuted draw are not SQL; tests/llm
# holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = shared_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
