"""The response log as Parquet with shredded bodies: a typed path is read without the rest of its body."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.responses import envelope

_SHRED = ("spark.sql.variant.writeShredding.enabled", "spark.sql.variant.inferShreddingSchema")


def write_log(log: DataFrame, folder: str, mode: str = "append") -> None:
    """Write logged answers with their bodies as VARIANT, each field that keeps its type a column of its own.

    Spark infers the fields per file. Empty and null bodies are empty objects, bodies that are not
    JSON are NULL. No rows give an empty log.
    """
    conf = log.sparkSession.conf
    before = {key: conf.get(key) for key in _SHRED}
    for key in _SHRED:
        conf.set(key, "true")
    try:
        envelope(log).write.mode(mode).parquet(folder)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def read_paths(spark: SparkSession, folder: str, paths: dict[str, tuple[str, str]], *columns: str) -> DataFrame:
    """The columns given and one for each of paths: name -> (path in the body, type).

    What is absent, null or of another type is NULL. With spark.sql.variant.pushVariantIntoScan, a
    scan reads these paths only.
    """
    found = [F.try_variant_get("body", path, kind).alias(name) for name, (path, kind) in paths.items()]
    return spark.read.parquet(folder).select(*columns, *found)
