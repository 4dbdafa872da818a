"""Shared pieces: reading a table, the word pattern, column clashes, folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: anything between the six white-space characters of ASCII.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names) -> DataFrame:
    """df without columns that an operator is about to add; its own result takes their place."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; NULL for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % F.lit(folds)


def word_count(text: str) -> Column:
    """Words of a text as BIGINT; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
