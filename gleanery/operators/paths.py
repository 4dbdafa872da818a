"""The path stage over landed answers: which size range to ask for next, and what came back.

The search service counts and lists at most a limited number of results, so a query is cut into
ranges of file sizes. Everything outside happens between two calls: open_ranges and open_cuts say
what to probe and list, next_ranges takes the landed counts and moves every query on, all in one
step. A range that is too much for one list is cut into pieces that are asked for side by side while
the query goes on behind it, so that the rounds of a scan grow with the logarithm of the axis, not
with the number of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .responses import ITEMS_PER_PAGE, PAGES_PER_QUERY, TRIES_PER_PAGE, usable_pages

# The service's limit, the largest size, the empty ranges that end a scan.
RESULT_LIMIT = 1000
MAX_SIZE = 1_000_000
EMPTY_RANGES = 10
FIRST_CHUNK = 10_000

#: What tells one landed page from another.
ATTEMPT = ["request", "scan", "page", "attempt"]
_RANGE = r" size:([0-9]+)\.\.([0-9]+)$"


def range_query(query: Column, lo: Column, hi: Column) -> Column:
    return F.concat(query, F.lit(" size:"), lo.cast("string"), F.lit(".."), hi.cast("string"))


def bounds(request: str) -> list[Column]:
    """size_min and size_max as the text of a request has them; NULL where it has none."""
    return [F.regexp_extract(request, _RANGE, i).try_cast("bigint").alias(n) for i, n in ((1, "size_min"), (2, "size_max"))]


def landed_items(items: DataFrame) -> DataFrame:
    """Items of landed pages in full: request, scan, page, attempt, item_no, total_count, url, sha; a repeated delivery once."""

    def given(name: str, other) -> Column:
        return F.col(name) if name in items.columns else F.lit(other)

    return items.select(
        F.col("query").alias("request"), given("scan", 0).cast("bigint").alias("scan"), given("page", 1).cast("bigint").alias("page"),
        given("attempt", 1).cast("bigint").alias("attempt"), given("item_no", None).cast("bigint").alias("item_no"),
        given("total_count", None).cast("bigint").alias("total_count"), "url", "sha",
    ).dropDuplicates([*ATTEMPT, "item_no", "url"])


def page_attempts(landed: DataFrame) -> DataFrame:
    """One row for each landed page attempt, empty ones too: ATTEMPT, n_items, total_count."""
    return landed.groupBy(*ATTEMPT).agg(F.count("url").alias("n_items"), F.max("total_count").alias("total_count"))


def lists(attempts: DataFrame, totals: DataFrame) -> DataFrame:
    """Per request the items on its walked pages (n_items) and whether its list is whole.

    attempts: page attempts of one scan of a request, from all deliveries so far. totals:
    request, total_count. A list is whole when it has all items that were announced or can be
    listed, when its pages are used up, or when the page behind the last came back empty: once,
    with as many items before it as could be expected, or as often as a page is tried. What
    else is not there may still land.
    """
    pages = attempts.join(totals.withColumnRenamed("total_count", "_counted"), "request", "left").select(
        F.col("request").alias("query"), "page", "attempt", "n_items", F.coalesce("total_count", "_counted").alias("total_count")
    )
    walked = usable_pages(pages).join(pages, ["query", "page", "attempt"]).groupBy("query").agg(
        F.sum("n_items").alias("listed"), F.max("page").alias("last")
    )
    at = pages.join(walked, "query", "left").withColumns(
        {"listed": F.coalesce("listed", F.lit(0)), "behind": F.coalesce("last", F.lit(0)) + 1}
    )
    tries = F.count_if((F.col("n_items") == 0) & (F.col("page") == F.col("behind")))
    found = at.groupBy("query", "listed", "behind").agg(
        F.min_by("total_count", F.struct("page", "attempt")).alias("expected"), tries.alias("tries")
    )
    expected = F.coalesce("expected", F.lit(0))
    enough = F.col("listed") >= F.least(expected, F.col("behind") * ITEMS_PER_PAGE)
    whole = (
        (F.col("expected").isNotNull() & (F.col("listed") >= F.least(expected, F.lit(RESULT_LIMIT))))
        | (F.col("behind") > PAGES_PER_QUERY) | (F.col("tries") >= TRIES_PER_PAGE) | ((F.col("tries") > 0) & enough)
    )
    return found.select(F.col("query").alias("request"), F.col("listed").alias("n_items"), whole.alias("whole"))


def open_ranges(
    queries: DataFrame, ranges: DataFrame, first_chunk: int = FIRST_CHUNK, max_size: int = MAX_SIZE, rescan: bool = False
) -> DataFrame:
    """The range each unfinished query is at: query, scan, lo, hi, chunk, empties, request.

    queries: query (distinct). ranges: the state table scan_ranges; a query that is not there
    starts at size 0. rescan: so do all, in a scan of a new number.
    """
    known = ranges.select("query", "lo", "chunk", "empties", "completed", "scan")
    if rescan:
        known = known.select("query", *[F.lit(None).alias(c) for c in ("lo", "chunk", "empties", "completed")], (F.col("scan") + 1).alias("scan"))
    at = queries.select("query").distinct().join(known, "query", "left").select(
        "query",
        F.coalesce("scan", F.lit(0)).cast("bigint").alias("scan"),
        F.coalesce("lo", F.lit(0)).cast("bigint").alias("lo"),
        F.coalesce("chunk", F.lit(first_chunk)).cast("bigint").alias("chunk"),
        F.coalesce("empties", F.lit(0)).cast("bigint").alias("empties"),
        F.coalesce("completed", F.lit(False)).alias("completed"),
    )
    hi = F.least(F.col("lo") + F.col("chunk") - 1, F.lit(max_size).cast("bigint"))
    return (
        at.filter(~F.col("completed")).drop("completed").withColumn("hi", hi)
        .withColumn("request", range_query(F.col("query"), F.col("lo"), F.col("hi")))
    )


def open_cuts(queries: DataFrame, ranges: DataFrame, cuts: DataFrame) -> DataFrame:
    """The open pieces of the queries' present scans, in the columns of open_ranges; chunk is a piece's width.

    cuts: the state table cut_ranges. Pieces of an earlier scan are given up with it.
    """
    present = queries.select("query").distinct().join(ranges.select("query", "scan"), "query")
    return cuts.filter("is_open").join(present, ["query", "scan"], "left_semi").select(
        "query", "scan", "lo", (F.col("hi") - F.col("lo") + 1).alias("chunk"), F.lit(0).cast("bigint").alias("empties"), "hi", "request"
    )


def next_ranges(probed: DataFrame, limit: int = RESULT_LIMIT, max_size: int = MAX_SIZE, empty_ranges: int = EMPTY_RANGES) -> DataFrame:
    """probed with action, next_lo, next_chunk, next_empties and completed.

    probed: query, lo, hi, chunk, empties, total_count (NULL: not answered yet), n_items (listed
    for the range, NULL: no list yet) and, where known, whole (nothing of the list is missing).
    Actions: pending (no count, or no whole list yet; nothing moves), empty (skip the range and
    double the chunk), narrow (too much for one list, halve it), collected (go on behind it),
    over_full (one size alone is over the limit: taken as far as it is listed, and marked).
    A scan ends behind max_size, or after `empty_ranges` empty ranges in a row (ended_empty).
    Nothing that has landed is dropped by any of this.
    """
    wide = F.col("lo") < F.col("hi")
    full = (F.col("total_count") >= limit) | (F.coalesce("n_items", F.lit(0)) >= limit)
    listed = F.coalesce("whole", F.lit(False)) if "whole" in probed.columns else F.col("n_items").isNotNull()
    action = (
        F.when(F.col("total_count").isNull(), "pending")
        .when(F.col("total_count") == 0, "empty")
        .when(full & wide, "narrow")
        .when(~listed, "pending")
        .when(F.coalesce("n_items", F.lit(0)) >= limit, "over_full")
        .otherwise("collected")
    )
    moved = F.col("action").isin("empty", "collected", "over_full")
    empties = F.when(F.col("action") == "empty", F.col("empties") + 1).when(F.col("action") == "pending", F.col("empties")).otherwise(0)
    stopped = (F.col("action") == "empty") & (F.col("next_empties") >= empty_ranges)
    doubled = F.least(F.col("chunk") * 2, F.lit(max_size).cast("bigint"))
    return (
        probed.withColumn("action", action)
        .withColumn("next_empties", empties.cast("bigint"))
        .withColumn("ended_empty", stopped)
        .withColumn("next_lo", F.when(moved & ~F.col("ended_empty"), F.col("hi") + 1).otherwise(F.col("lo")))
        .withColumn(
            "next_chunk",
            F.when(F.col("action") == "narrow", F.greatest(F.floor(F.col("chunk") / 2), F.lit(1)).cast("bigint"))
            .when(moved & ~F.col("ended_empty"), doubled).otherwise(F.col("chunk")),
        )
        .withColumn("completed", F.col("ended_empty") | (F.col("next_lo") > max_size))
    )


def cut_ranges(moved: DataFrame, limit: int = RESULT_LIMIT) -> DataFrame:
    """The pieces of all narrowed ranges: request, query, scan, lo, hi.

    Of equal width, two for each list that the count would fill, at least two, and none narrower
    than one size: together they are the range.
    """
    width = F.col("hi") - F.col("lo") + 1
    wanted = F.greatest(F.ceil(F.col("total_count") * 2 / limit), F.lit(2)).cast("bigint")
    step = F.ceil(width / F.least(wanted, width)).cast("bigint")
    starts = F.explode(F.sequence("lo", "hi", step)).alias("_lo")
    pieces = moved.filter("action = 'narrow'").select("query", "scan", "hi", step.alias("_step"), starts)
    piece_hi = F.least(F.col("_lo") + F.col("_step") - 1, F.col("hi"))
    return pieces.select(
        range_query(F.col("query"), F.col("_lo"), piece_hi).alias("request"), "query", "scan", F.col("_lo").alias("lo"), piece_hi.alias("hi")
    )


def behind_cuts(moved: DataFrame, max_size: int = MAX_SIZE) -> DataFrame:
    """moved, narrowed ranges counting as done: their query goes on behind them, with a doubled chunk."""
    narrowed = F.col("action") == "narrow"
    doubled = F.least(F.col("chunk") * 2, F.lit(max_size).cast("bigint"))
    return moved.withColumns({
        "next_lo": F.when(narrowed, F.col("hi") + 1).otherwise(F.col("next_lo")),
        "next_chunk": F.when(narrowed, doubled).otherwise(F.col("next_chunk")),
        "completed": F.when(narrowed, F.col("hi") >= max_size).otherwise(F.col("completed")),
    })
