"""The content tree: listing, membership, table sink and folder export."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import batched

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..session import checkpointed

RECORDS_PER_FILE = 1_000_000
NAMES_PER_BATCH = 10_000


def list_tree(spark: SparkSession, base: str) -> DataFrame:
    """Relative paths of all files below base (a folder all executors share).

    The walk goes level by level: each round lists the folders the last one found, spread
    over the executors, so no task walks a whole repository. Spark's own file listing would
    leave out names that start with a dot or an underscore.
    """

    def list_folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder in batch["rel_path"]:
                place = os.path.join(base, folder)
                if not os.path.isdir(place):
                    continue
                with os.scandir(place) as entries:
                    for some in batched(entries, NAMES_PER_BATCH):
                        yield pd.DataFrame(
                            {
                                "rel_path": [os.path.join(folder, e.name) for e in some],
                                "is_folder": [e.is_dir(follow_symlinks=False) for e in some],
                            }
                        )

    found_schema = "rel_path string, is_folder boolean"
    files = spark.createDataFrame([], "rel_path string")
    folders = spark.createDataFrame([("",)], "rel_path string")
    while True:
        level = checkpointed(folders.mapInPandas(list_folders, found_schema))
        files = files.unionByName(level.filter(~F.col("is_folder")).select("rel_path"))
        below = level.filter("is_folder").select("rel_path")
        if below.isEmpty():
            return files
        folders = below.repartition(spark.sparkContext.defaultParallelism, "rel_path")


def split_on_disk(parsed: DataFrame, tree: DataFrame) -> DataFrame:
    """parsed files with on_disk: whether their place in the tree is taken. One left join."""
    rel = urls.content_path(F.col("owner"), F.col("repo"), F.col("ref"), F.col("path"))
    there = tree.select("rel_path").distinct().withColumn("_there", F.lit(True))
    return (
        parsed.withColumn("rel_path", rel)
        .join(there, "rel_path", "left")
        .withColumn("on_disk", F.coalesce("_there", F.lit(False)))
        .drop("_there")
    )


def write_content_table(content: DataFrame, path: str, run: str, stage: str = "batch", resume: bool = False) -> DataFrame:
    """Write the handled items of one run and read them back.

    One folder per run, stage and status. A stage that was killed may be written again; one that
    is finished is never replaced: its name is refused, or with `resume` what it has written is
    read. Rows stay where they are: a repartition by repository would put one that holds most
    files into one task.
    """
    folder = f"{path}/run={run}/stage={stage}"
    spark = content.sparkSession
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        if resume:
            return spark.read.schema(content.schema).parquet(folder)
        raise ValueError(f"run {run} is finished; take a new name")
    (
        content.write.mode("overwrite")
        .partitionBy("status")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .parquet(folder)
    )
    schema = content.schema
    return spark.read.schema(schema).parquet(folder)


def _write_one(base: str, rel_path: str, text: str) -> str:
    target = os.path.join(base, rel_path)
    try:
        os.makedirs(os.path.dirname(target), exist_ok=True)
        draft = f"{target}.{os.getpid()}.part"
        with open(draft, "w", encoding="utf-8", newline="") as out:
            out.write(text)
        os.replace(draft, target)
    except OSError:
        return "error"
    return "fetched"


def export_tree(content: DataFrame, base: str) -> DataFrame:
    """Write each text to its place below base (a folder all executors share).

    Returns url, status: a failed write is an error. Writes are atomic and repeatable, so a
    retried task changes nothing.
    """
    rel = urls.content_path(F.col("owner"), F.col("repo"), F.col("ref"), F.col("path"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            status = [_write_one(base, r, t) for r, t in zip(batch["rel_path"], batch["text"])]
            yield pd.DataFrame({"url": batch["url"], "status": status})

    return content.select("url", rel.alias("rel_path"), "text").mapInPandas(
        write, "url string, status string"
    )


def json_lines(table: DataFrame) -> DataFrame:
    """Each row of a table as one JSON text (the documented metadata and history outputs)."""
    return table.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def export_json(table: DataFrame, path: str) -> None:
    json_lines(table).write.mode("overwrite").text(path)
