"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "gleanery", **conf: str) -> SparkSession:
    """A session with the defaults above; master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables of the jobs within are deleted at the end, whether these succeed or not.

    What a job returns may still read them: write or collect it within.
    """
    folder = shared_folder(spark)
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in spark.checkpoint.dir, or below that of scratch().

    Where that is unset, local mode (tests) takes a temporary folder for the session.
    """
    if _scratch.get() is not None:
        return f"{_scratch.get()}/{uuid.uuid4().hex}"
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if shared is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(os.path.join(tempfile.mkdtemp(prefix="run-"), "checkpoints"))
        shared = sc.getCheckpointDir()
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write df once as a table in the shared folder and go on from there.

    The copy survives lost executors, is read by column, and has a known size for AQE.
    """
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
