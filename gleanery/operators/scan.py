"""Cutting result-capped searches into size ranges that stay under the cap."""

from __future__ import annotations

from array import array
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import ranged_query
from .ordering import first_n
from .ranges import assign_ranges


@dataclass(frozen=True)
class ScanLimits:
    """Fixed values of the search service and of the scan."""

    cap: int = 1000
    first_chunk: int = 10_000
    max_size: int = 1_000_000
    empty_stop: int = 10


DEFAULT_LIMITS = ScanLimits()

ACTIONS = ("empty", "stop", "narrow", "overflow", "collect")

PLAN_SCHEMA = "query string, step long, lo long, hi long, est long, got long, action string"


def size_histogram(items: DataFrame, limits: ScanLimits = DEFAULT_LIMITS, off_axis: bool = False) -> DataFrame:
    """Items per query and size on the scan axis, with the running count of the query.

    At most max_size + 1 rows per query whatever the number of items. With off_axis, items that
    no range of the axis can list (longer ones, null and negative sizes) are one more row of their
    query, size NULL, and come last in its running count; otherwise they are left out.
    """
    on_axis = F.col("size_bytes").between(0, limits.max_size)
    kept = items if off_axis else items.filter(on_axis)
    counts = kept.groupBy("query", F.when(on_axis, F.col("size_bytes")).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    so_far = (
        Window.partitionBy("query")
        .orderBy(F.col("size").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return counts.withColumn("running", F.sum("n").over(so_far))


def reported_totals(items: DataFrame) -> DataFrame:
    """Unsharded count per query."""
    return items.groupBy("query").agg(F.count(F.lit(1)).alias("total_count"))


def open_scans(
    queries: DataFrame, progress: DataFrame, rescan: bool = False
) -> DataFrame:
    """Queries still to scan and where each starts; finished ones drop out unless rescan."""
    starts = queries.select("query").distinct()
    if rescan:
        return starts.withColumn("start_lo", F.lit(0).cast("bigint"))
    known = progress.select("query", "last_lo", "completed_at")
    return (
        starts.join(known, "query", "left")
        .filter(F.col("completed_at").isNull())
        .select("query", F.coalesce("last_lo", F.lit(0)).cast("bigint").alias("start_lo"))
    )


def _walker(limits: ScanLimits):
    """The scan of one query over its histogram; the state is four numbers."""

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        query = rows["query"].iloc[0]
        lo = int(rows["start_lo"].max())
        counted = rows[rows["size"].notna()].sort_values("size")
        sizes = counted["size"].to_numpy(dtype=np.int64)
        totals = {
            name: np.concatenate(([0], np.cumsum(counted[name].to_numpy(dtype=np.int64))))
            for name in ("est", "n")
        }
        chunk, empties = limits.first_chunk, 0
        # A walk may take two steps per byte size, so steps are kept as packed columns.
        steps = {name: array("q") for name in ("lo", "hi", "est", "got")}
        actions = array("b")
        while lo <= limits.max_size:
            hi = min(lo + chunk - 1, limits.max_size)
            left, right = np.searchsorted(sizes, (lo, hi + 1))
            est = int(totals["est"][right] - totals["est"][left])
            divisible = lo < hi
            got = -1
            if est == 0:
                empties += 1
                action = "stop" if empties >= limits.empty_stop else "empty"
            else:
                empties = 0
                if est >= limits.cap and divisible:
                    action = "narrow"
                else:
                    got = min(int(totals["n"][right] - totals["n"][left]), limits.cap)
                    action = "overflow" if got >= limits.cap and divisible else "collect"
            for name, value in zip(steps, (lo, hi, est, got)):
                steps[name].append(value)
            actions.append(ACTIONS.index(action))
            if action == "stop":
                break
            if action in ("narrow", "overflow"):
                chunk = max(chunk // 2, 1)
            else:
                lo, chunk = hi + 1, min(chunk * 2, limits.max_size)
        columns = {name: np.array(values, dtype=np.int64) for name, values in steps.items()}
        columns["got"] = pd.array(columns["got"], dtype="Int64")
        columns["got"][columns["got"] < 0] = pd.NA
        named = np.array(ACTIONS, dtype=object)[np.array(actions, dtype=np.int8)]
        plan = {"query": query, "step": np.arange(len(actions)), **columns, "action": named}
        return pd.DataFrame(plan)

    return walk


def scan_plan(
    items: DataFrame,
    estimates: DataFrame | None = None,
    scans: DataFrame | None = None,
    limits: ScanLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """The ranges asked for, in order, with the estimate, what came back and what followed.

    items: query, size_bytes. estimates: query, size, est (what the service claims; defaults
    to the true counts). scans: query, start_lo (defaults to every query from 0).
    action is empty, stop, narrow (estimate at the cap), overflow (result at the cap though
    the estimate was below it) or collect. Counting happens before the shuffle, so one
    query's group holds at most one row per byte size.
    """
    on_axis = F.col("size_bytes").between(0, limits.max_size)
    actual = (
        items.filter(on_axis)
        .groupBy("query", F.col("size_bytes").alias("size"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if estimates is None:
        counts = actual.withColumn("est", F.col("n"))
    else:
        claimed = estimates.filter(F.col("size").between(0, limits.max_size)).select(
            "query", "size", F.lit(0).cast("bigint").alias("n"), F.col("est").cast("bigint").alias("est")
        )
        both = actual.withColumn("est", F.lit(0).cast("bigint")).unionByName(claimed)
        counts = both.groupBy("query", "size").agg(F.sum("n").alias("n"), F.sum("est").alias("est"))
    if scans is None:
        scans = items.select("query").distinct().withColumn("start_lo", F.lit(0).cast("bigint"))

    # One extra row per query carries its start, so that queries without items walk too.
    starts = scans.select(
        "query",
        "start_lo",
        F.lit(None).cast("bigint").alias("size"),
        F.lit(0).cast("bigint").alias("n"),
        F.lit(0).cast("bigint").alias("est"),
    )
    ahead = counts.join(scans, "query").filter(F.col("size") >= F.col("start_lo"))
    rows = starts.unionByName(ahead.select(*starts.columns))
    return rows.groupBy("query").applyInPandas(_walker(limits), PLAN_SCHEMA)


def fetched_items(plan: DataFrame, items: DataFrame, limits: ScanLimits = DEFAULT_LIMITS) -> DataFrame:
    """Items every range request returned: the first `cap` of the range in item order.

    Only requests whose result reached the cap need an order; the others return all their
    items as they come out of the join. A size shared by very many items is cut by every
    task before the ranking shuffle, and AQE splits it in the join.
    """
    asked = plan.filter(F.col("action").isin("overflow", "collect")).select(
        "query", "step", "lo", "hi", "action", (F.col("got") >= limits.cap).alias("_full")
    )
    on_axis = items.filter(F.col("size_bytes").between(0, limits.max_size))
    returned = assign_ranges(on_axis, asked, ["query"], "size_bytes", "lo", "hi")
    whole = returned.filter(~F.col("_full"))
    cut = first_n(returned.filter("_full"), ["query", "step"], ["seq", "url"], limits.cap)
    return whole.unionByName(cut).drop("_full")


def scan_hits(fetched: DataFrame) -> DataFrame:
    """Log rows of every request, overflowed ones too, under the range-limited query text."""
    return fetched.select(
        "url",
        ranged_query(F.col("query"), F.col("lo"), F.col("hi")).alias("query"),
        F.col("lo").alias("size_min"),
        F.col("hi").alias("size_max"),
    )


def scan_collected(fetched: DataFrame) -> DataFrame:
    """Items of accepted ranges, in the order of the scan."""
    return fetched.filter(F.col("action") == "collect")


def scan_progress_rows(plan: DataFrame, limits: ScanLimits = DEFAULT_LIMITS) -> DataFrame:
    """Where each scan ended. A scan stopped by empty ranges stays at the last of them."""
    last = F.max_by(F.struct("lo", "hi", "action"), "step")
    return plan.groupBy("query").agg(last.alias("_last")).select(
        "query",
        F.when(F.col("_last.action") == "stop", F.col("_last.lo"))
        .otherwise(F.col("_last.hi") + 1)
        .alias("last_lo"),
        F.lit(limits.max_size).cast("bigint").alias("max_size"),
    )

