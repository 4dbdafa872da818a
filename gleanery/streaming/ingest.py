"""Resumable ingest of landed search pages into the state tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.ordering import with_position
from ..operators.responses import search_items
from ..operators.state import new_files
from ..session import checkpointed
from ..sources.state_store import ConcurrentChange, StateStore

_RANGE = r" size:([0-9]+)\.\.([0-9]+)$"


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the stream keeps in its checkpoint: a new checkpoint is another stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def take_in(store: StateStore, pages: DataFrame, stream: str, batch_id: int) -> None:
    """Store the pages of one micro-batch: items as hits, new URLs as files, broken lines as rejects.

    All of it is one commit under the batch's name: a killed batch has left nothing and is
    repeated, a finished one is not. Where another writer has added files meanwhile, the batch is
    worked out again, so that a URL is never added twice.
    """
    once = f"{stream}-{batch_id}"
    if store.done(once):
        return
    landed = checkpointed(pages)
    now = F.current_timestamp()
    items = search_items(landed.filter(F.col("query").isNotNull())).filter(F.col("url").isNotNull())
    bounds = [F.regexp_extract("query", _RANGE, i).try_cast("bigint").alias(n) for i, n in ((1, "size_min"), (2, "size_max"))]
    # The first of a URL is that of page order, then of the place on the page.
    order = F.struct("query", "page", "attempt", "item_no").alias("seq")
    while True:
        commit = store.begin(once, reads=("files",))
        commit.append("rejected_pages", landed.filter(F.col("_line").isNotNull()).select("query", F.col("_line").alias("line")))
        commit.append("search_hits", items.select("url", "query", *bounds, now.alias("hit_at")))
        known = commit.read("files")
        fresh = checkpointed(new_files(known, items.select("url", "sha", order)).select(
            "url", "sha", F.monotonically_increasing_id().alias("seq")
        ))
        behind = known.agg(F.coalesce(F.max("seq") + 1, F.lit(0)).alias("_behind")).first()["_behind"]
        placed = with_position(fresh, "seq", "_position")
        commit.append("files", placed.select(
            "url", "sha", (F.col("_position") + F.lit(behind)).alias("seq"), now.alias("discovered_at")
        ))
        mark = store.spark.range(1).select(F.lit(stream).alias("stream"), F.lit(batch_id).alias("batch_id"))
        commit.append("ingested_batches", mark)
        try:
            commit.publish()
            return
        except ConcurrentChange:
            continue


def ingest_pages(
    spark: SparkSession,
    landed: str,
    target: str,
    checkpoint: str,
    max_files: int = 10_000,
) -> StreamingQuery:
    """Take every landed page not seen yet into the state tables below target, then stop."""
    StateStore(spark, target).create()
    pages = (
        spark.readStream.schema(schemas.LANDED_PAGE)
        .option("columnNameOfCorruptRecord", "_line")
        .option("maxFilesPerTrigger", max_files)
        .json(landed)
    )

    def batch_in(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        take_in(StateStore(session, target), batch, _stream_id(session, checkpoint), batch_id)

    return (
        pages.writeStream.foreachBatch(batch_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingested_files(spark: SparkSession, target: str) -> DataFrame:
    return StateStore(spark, target).read("files")
