"""Ledger of outstanding requests: who asks for which item, until when, and what was asked."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import checkpointed
from ..sources.state_store import ConcurrentChange, StateStore

LEASE_HOURS = 24


def lease(store: StateStore, stage: str, wanted: DataFrame, item: str, planner: str, asof: str, hours: int = LEASE_HOURS) -> DataFrame:
    """The wanted rows whose item nobody else is asking for; they are this planner's for some hours.

    Of two planners that want the same item at the same time one is first: the other finds its
    lease when it tries to publish its own, and looks again. A planner gets its own items anew.
    """
    wanted = checkpointed(wanted)
    ends = F.lit(asof).cast("timestamp") + F.expr(f"INTERVAL {int(hours)} HOURS")
    while True:
        commit = store.begin(reads=("leases",))
        held = commit.read("leases").filter(
            (F.col("stage") == stage) & (F.col("planner") != planner) & (F.col("ends_at") > F.lit(asof).cast("timestamp"))
        ).select(F.col("item").alias(item))
        granted = checkpointed(wanted.join(held, item, "left_anti"))
        commit.append("leases", granted.select(
            F.lit(stage).alias("stage"), F.col(item).alias("item"), F.lit(planner).alias("planner"), ends.alias("ends_at")
        ))
        try:
            commit.publish()
            return granted
        except ConcurrentChange:
            continue


def remember(store: StateStore, stage: str, planner: str, open_items: DataFrame, requests: DataFrame) -> None:
    """Keep what a plan asks for, so that its answers find their items whenever they land."""
    rows = open_items.join(requests.select("batch_id", "request_key"), "batch_id").select(
        F.lit(stage).alias("stage"), F.lit(planner).alias("planner"), "request_key",
        F.to_json(F.struct(*open_items.columns), {"ignoreNullFields": "false"}).alias("item"),
        F.lit(open_items.schema.json()).alias("shape"),
    )
    store.append("asked_items", rows, once=f"{stage}-{planner}")


def answered_plan(store: StateStore, stage: str, answers: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(open_items, requests) of all requests of a stage that have an answer here, whichever plan asked; None if none was asked.

    Plans number their batches anew; here a batch is known by its request. Two plans may have sent
    the very same request: its items count once.
    """
    asked = store.read("asked_items").filter(F.col("stage") == stage)
    known = checkpointed(asked.join(answers.select("request_key").distinct(), "request_key", "left_semi"))
    first = known.select("shape").first()
    if first is None:
        return None
    shape = StructType.fromJson(json.loads(first["shape"]))
    rows = known.select("request_key", F.from_json("item", shape).alias("item")).select("request_key", "item.*")
    batch = F.xxhash64("request_key")
    open_items = rows.drop("batch_id").withColumn("batch_id", batch).dropDuplicates([c for c in rows.columns if c != "seq"])
    return (
        checkpointed(open_items.select(*[f.name for f in shape.fields])),
        checkpointed(known.select(batch.alias("batch_id"), "request_key").distinct()),
    )
