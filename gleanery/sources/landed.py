"""Readers of landed files: search pages, batched answers, the flat response cache."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def read_search_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed search pages as JSON lines, with the declared schema (no inference).

    A page with an odd item keeps its other items, and the whole line stands in `_line`. A line that
    is not a page counts as a page not landed yet; rejected_pages has it.
    """
    return _landed_pages(spark, path).filter(F.col("query").isNotNull())


def rejected_pages(spark: SparkSession, path: str) -> DataFrame:
    """Lines that could not be read in full: query (null where nothing could be read) and line."""
    parsed = F.from_json("value", schemas.LANDED_PAGE, {"columnNameOfCorruptRecord": "_line"})
    lines = spark.read.text(path).select(parsed.alias("page"))
    return lines.filter(F.col("page._line").isNotNull()).select("page.query", F.col("page._line").alias("line"))


def _landed_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LANDED_PAGE).option("columnNameOfCorruptRecord", "_line").json(path)


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """Landed batched answers: the key of the request, the time of the answer and the body as text."""
    return spark.read.schema("request_key string, answered_at timestamp, body string").json(path)


def cache_rows(files: DataFrame) -> DataFrame:
    """Cache files (path, content, modificationTime) as cache rows.

    Broken UTF-8 is repaired; empty files and text that is not JSON are misses and drop out.
    """
    text = F.make_valid_utf8(F.col("content").cast("string"))
    parsed = files.withColumn("_text", text).withColumn("_json", F.try_parse_json("_text"))
    return parsed.filter(F.col("_json").isNotNull()).select(
        F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("key"),
        F.col("_text").alias("body"),
        F.try_variant_get("_json", "$.error", "string").alias("error"),
        F.col("modificationTime").alias("cached_at"),
    )


def read_flat_cache(spark: SparkSession, path: str) -> DataFrame:
    """A folder of {key}.json files as cache rows."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return cache_rows(files)
