"""Corpus pipeline: language, quality, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's `docs`. All but the last
return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelspark.llm import op2_near_duplicates, op7_packing, op8_quality, op9_pii, op10_language
from panelspark.llm.common import documents, shared_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and texts whose words are too little evidence for any learned language."""
    return op10_language.keep_known(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that fail a rule of the production policy."""
    return op8_quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each class of near-duplicates, that with the smallest doc_id."""
    return op2_near_duplicates.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the text by its kind; n_chars follows."""
    return op9_pii.redact(docs, n_chars="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document: shard, bin and offset."""
    return op7_packing.pack(docs, op7_packing.words_in("text"), op7_packing.same_words("text"))


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("packing", packing)]

#: The stages are a trained model, near-duplicate classes and a packing heuristic; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = documents(spark, sf_dir), shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
