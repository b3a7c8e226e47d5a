"""Small helpers shared by the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.session import ensure_checkpoint_dir

# The ASCII white space that separates words.
WORD_GAP = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder (created by whoever writes to it first)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write once to the shared checkpoint folder; later reads don't depend on executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free_name(df_or_columns, wanted: str) -> str:
    """`wanted`, or `wanted_1`, `wanted_2`, ... if the input has such a column already (names compare without case)."""
    taken = {c.lower() for c in getattr(df_or_columns, "columns", df_or_columns)}
    name, n = wanted, 0
    while name.lower() in taken:
        n += 1
        name = f"{wanted}_{n}"
    return name


def split_words(text: Column) -> Column:
    """Words between ASCII white space, in order; null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))


def computed_once(df: DataFrame, column: str) -> DataFrame:
    """The same rows. Conditions on `column` are not pushed into the expressions that make it, where each reference
    would compute them again: they stay above a generator of one element."""
    return df.select(*(c for c in df.columns if c != column), F.explode(F.array(F.col(column))).alias(column)).select(*df.columns)
