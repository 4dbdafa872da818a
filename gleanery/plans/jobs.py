"""The five user-level jobs: collect paths, content, metadata, history, compare.

Each job reads state tables, works out what is missing and writes a new state. Between a
request and its answer lies the outside world, so the three enrichment jobs come in two
halves: plan_* says what to ask, record_* takes the landed answers.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import commits, keys, text
from ..operators import audit, batching, cache, paths, responses, scan, state
from ..operators.ordering import last_wins, with_position
from ..session import checkpointed
from ..sources.content_tree import split_on_disk, write_content_table
from ..sources.state_store import Commit, ConcurrentChange, StateStore
from . import ledger

# Endpoints under which answers are cached.
CONTENT, METADATA, HISTORY = "contents", "repo_metadata", "file_history"


@dataclass(frozen=True)
class Plan:
    """What a planning half found: items by fate, and the requests for the open ones.

    open_items and requests are written out, so the batches a request was made for are the same
    when its answer is recorded. An answer is matched by request_key, the hash of the request's
    text: batch numbers start anew in every plan, and an older answer may still be at hand.
    """

    rejected: DataFrame | None
    skipped: DataFrame | None
    hits: DataFrame
    open_items: DataFrame
    requests: DataFrame


def cached_answers(store: StateStore, given: DataFrame | None, endpoint: str) -> DataFrame:
    """The cache that was given, or what the state holds for an endpoint; other endpoints are not read."""
    if given is not None:
        return given
    return store.read("response_cache").filter(F.col("endpoint") == endpoint).drop("endpoint")


def add_answers(store: StateStore | Commit, entries: DataFrame, endpoint: str, asof: str) -> None:
    """Append entries (key, body, error) to the stored cache. Lookups take the latest of a key."""
    stamped = entries.select("key", "body", "error").withColumns(
        {"endpoint": F.lit(endpoint), "cached_at": F.lit(asof).cast("timestamp")}
    )
    store.append("response_cache", stamped)


def error_body(error):
    """Cached form of an error."""
    return F.to_json(F.struct(error.alias("error")))


def _unanswered(plan: Plan, answers: DataFrame) -> DataFrame:
    """Open items of batches without an answer: they stay pending."""
    return plan.open_items.join(_answers_of(plan, answers).select("batch_id"), "batch_id", "left_anti").select(
        F.lit("pending").alias("outcome"), F.lit(False).alias("is_hit")
    )


def _cache_split(wanted: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hits and misses. Only the narrow requests are written out, never cached bodies."""
    written = checkpointed(wanted)
    return cache.hits(written, entries), cache.misses(written, entries)


def _keyed(requests: DataFrame) -> DataFrame:
    """Requests with their key, hashed once for each batch and written."""
    return checkpointed(requests.withColumn("request_key", F.sha2("request", 256)))


def _leased(store: StateStore, stage: str, misses: DataFrame, item: str, planner: str | None, asof: str) -> DataFrame:
    """Misses that no other planner is asking for; without a name of the planner, all."""
    return misses if planner is None else ledger.lease(store, stage, misses, item, planner, asof)


def _remembered(store: StateStore, stage: str, planner: str | None, plan: Plan) -> Plan:
    if planner is not None:
        ledger.remember(store, stage, planner, plan.open_items, plan.requests)
    return plan


def late_plan(store: StateStore, stage: str, answers: DataFrame) -> Plan | None:
    """A plan of all items that these answers are for, whichever planner asked for them, and whether or not its lease has ended.

    record_metadata, record_history and record_content take it like any other; what is stored
    already is replaced, never doubled. None where no answer is to a request of the ledger.
    """
    found = ledger.answered_plan(store, stage, answers)
    if found is None:
        return None
    open_items, requests = found
    nothing = open_items.limit(0)
    empty = nothing.select(*[c for c in nothing.columns if c != "batch_id"]).withColumns(
        {"body": F.lit(None).cast("string"), "error": F.lit(None).cast("string"), "cached_at": F.lit(None).cast("timestamp")}
    )
    none = nothing.select(F.lit(None).cast("string").alias("url"))
    return Plan(none, none, empty, open_items, requests)


def _answers_of(plan: Plan, answers: DataFrame) -> DataFrame:
    """batch_id and body of the plan's answers, the latest of each request; answers of other plans drop out.

    answers: request_key, body and, where known, answered_at.
    """
    return plan.requests.select("batch_id", "request_key").join(responses.latest_answers(answers), "request_key")


def put(commit: Commit, table: str, updates: DataFrame, key: str, upsert=None) -> None:
    """Rows replace stored ones of equal keys; of the new ones of a key the last counts."""
    shaped = (upsert or state.upsert)(commit.read(table).limit(0), updates, *([] if upsert else [key]))
    commit.upsert(table, shaped, key)


# --- paths -------------------------------------------------------------------------------


def collect_paths(
    store: StateStore,
    items: DataFrame,
    asof: str,
    estimates: DataFrame | None = None,
    limits: scan.ScanLimits = scan.DEFAULT_LIMITS,
    rescan: bool = False,
) -> DataFrame:
    """Scan every open query over its landed items; returns the plan that was walked.

    items: seq, query, url, sha, size_bytes.
    """
    scans = scan.open_scans(items, store.read("scan_progress"), rescan)
    plan = checkpointed(scan.scan_plan(items, estimates, scans, limits))
    fetched = checkpointed(scan.fetched_items(plan, items, limits))

    known = store.read("files")
    found = checkpointed(state.new_files(known, scan.scan_collected(fetched)).select("seq", "url", "sha"))
    # New files go behind the known ones, in item order.
    behind = known.agg(F.coalesce(F.max("seq") + 1, F.lit(0)).alias("_behind")).first()["_behind"]
    placed = with_position(found, "seq", "_position")
    fresh = placed.select(
        "url",
        "sha",
        (F.col("_position") + F.lit(behind)).alias("seq"),
        F.lit(asof).cast("timestamp").alias("discovered_at"),
    )
    commit = store.begin()
    commit.append("search_hits", scan.scan_hits(fetched).withColumn("hit_at", F.lit(asof).cast("timestamp")))
    commit.append("files", fresh)

    # The count of a progress row is that of the whole table, as it stands after the run.
    total = known.count() + found.count()
    ended = (
        scan.scan_progress_rows(plan, limits)
        .withColumn("collected", F.lit(total).cast("bigint"))
        .withColumn("completed", F.lit(True))
        .withColumn("seq", F.lit(0))
    )
    commit.upsert("scan_progress", state.upsert_progress(commit.read("scan_progress").limit(0), ended, asof), "query")
    commit.publish()
    return plan


def plan_paths(store: StateStore, queries: DataFrame, first_chunk: int = paths.FIRST_CHUNK, rescan: bool = False) -> DataFrame:
    """The open ranges of every query, written: request is what to count and to list.

    One is where the query stands (is_cut false); the others are pieces of ranges that were too
    much for one list. rescan: start anew from size 0, also finished queries; scan numbers the
    scans of a query.
    """
    ranges = store.read("scan_ranges")
    found = paths.open_ranges(queries, ranges, first_chunk, rescan=rescan).withColumn("is_cut", F.lit(False))
    if not rescan:
        cuts = paths.open_cuts(queries, ranges, store.read("cut_ranges"))
        found = found.unionByName(cuts.withColumn("is_cut", F.lit(True)))
    return checkpointed(found)


def record_paths(store: StateStore, plan: DataFrame, probes: DataFrame, items: DataFrame, asof: str) -> DataFrame:
    """Store what has landed and move every query on whose list is whole; returns the new ranges.

    probes: request, total_count (the largest answer of a request counts). items: query (the
    request), url, sha, page, attempt, item_no and total_count, as search_items gives them, and
    scan where it is not the first. Every landed item goes to search_hits and files, also those
    of over-full, earlier or unknown ranges; a page attempt that was taken in before is not taken
    in again. A range is pending until its count is known and the walk over its pages has come
    to an end, over as many calls as that takes. Items without page and attempt are a whole list.
    A range that is too much for one list is cut, and its query goes on behind it; a query is
    completed when it has come to its end and no piece is open.

    All tables change in one commit, so that a killed call can be repeated, and so can a finished one.
    """
    landed = checkpointed(paths.landed_items(items))
    paged = "page" in items.columns
    stamp = F.lit(asof).cast("timestamp")
    while True:
        commit = store.begin(reads=("files", "landed_pages", "scan_ranges", "cut_ranges"))
        taken = commit.read("landed_pages")
        fresh_pages = checkpointed(paths.page_attempts(landed).join(taken, paths.ATTEMPT, "left_anti"))
        fresh = checkpointed(
            landed.filter(F.col("url").isNotNull()).join(fresh_pages.select(*paths.ATTEMPT), paths.ATTEMPT, "left_semi")
            .withColumn("seq", F.monotonically_increasing_id())
        )
        known_pages = taken.unionByName(fresh_pages).join(plan.select("request", "scan"), ["request", "scan"], "left_semi")
        totals = probes.groupBy("request").agg(F.max("total_count").alias("total_count"))
        asked = plan.join(totals, "request", "left")
        listed = paths.lists(known_pages, totals) if paged else paths.lists(known_pages, totals).withColumn("whole", F.lit(True))
        moved = checkpointed(paths.behind_cuts(paths.next_ranges(asked.join(listed, "request", "left"))))

        known = commit.read("files")
        found = state.new_files(known, fresh.select("seq", "url", "sha"))
        behind = known.agg(F.coalesce(F.max("seq") + 1, F.lit(0)).alias("_behind")).first()["_behind"]
        placed = checkpointed(with_position(checkpointed(found), "seq", "_position"))
        commit.append("search_hits", fresh.select(
            "url", F.col("request").alias("query"), *paths.bounds("request"), stamp.alias("hit_at")
        ))
        commit.append("files", placed.select(
            "url", "sha", (F.col("_position") + F.lit(behind)).alias("seq"), stamp.alias("discovered_at")
        ))
        commit.append("landed_pages", fresh_pages)

        place = checkpointed(moved.filter("not is_cut").select(
            "query", F.col("next_lo").alias("lo"), F.col("next_chunk").alias("chunk"), F.col("next_empties").alias("empties"),
            "completed", "action", "scan",
        ))
        commit.upsert("scan_ranges", place, "query")
        # a piece is closed for good, and cut once, however often its plan is recorded
        stored = checkpointed(commit.read("cut_ranges"))
        ended = moved.filter("is_cut and action <> 'pending'").join(stored.filter("is_open"), ["request", "scan"], "left_semi").select(
            "request", "query", "scan", "lo", "hi", "action", F.lit(False).alias("is_open")
        )
        fresh_cuts = paths.cut_ranges(moved).join(stored, ["request", "scan"], "left_anti").withColumn("is_open", F.lit(True))
        cuts = checkpointed(ended.unionByName(fresh_cuts, allowMissingColumns=True))
        commit.upsert("cut_ranges", cuts, "scan")
        # the count of a progress row is that of the whole table, as it stands after this call
        asked_for = plan.select("query").distinct()
        known_ranges = commit.read("scan_ranges").join(asked_for, "query", "left_semi").join(place, "query", "left_anti")
        at = place.unionByName(known_ranges)
        still = stored.join(cuts, ["request", "scan"], "left_anti").unionByName(cuts)
        waiting = paths.open_cuts(asked_for, at, still).select("query").distinct().withColumn("_waits", F.lit(True))
        progress = at.join(waiting, "query", "left").select(
            "query", F.col("lo").alias("last_lo"), F.lit(paths.MAX_SIZE).cast("bigint").alias("max_size"),
            F.lit(known.count() + placed.count()).cast("bigint").alias("collected"),
            (F.col("completed") & F.col("_waits").isNull()).alias("completed"), F.lit(0).alias("seq"),
        )
        commit.upsert("scan_progress", state.upsert_progress(commit.read("scan_progress").limit(0), progress, asof), "query")
        try:
            commit.publish()
            return moved
        except ConcurrentChange:
            continue


# --- content -----------------------------------------------------------------------------


def plan_content(
    store: StateStore,
    tree: DataFrame,
    response_cache: DataFrame | None,
    asof: str,
    batch_size: int = batching.CONTENT_BATCH,
    skip_read: bool = False,
    planner: str | None = None,
) -> Plan:
    """Pending files split into rejected, on disk, cached and open; the open ones batched.

    planner: a name under which open items are leased and remembered in the ledger.
    """
    pending = state.files_without_content(store.read("files"), store.read("content_status"))
    split = split_on_disk(state.parsed_files(pending), tree)
    place = [F.col(c) for c in ("owner", "repo", "ref", "path")]
    wanted = split.filter(~F.col("on_disk")).select(
        "url", *place, "seq", keys.content_key(*place).alias("key")
    )
    entries = cached_answers(store, response_cache, CONTENT)
    hits, misses = _cache_split(wanted, cache.readable_entries(entries, asof, skip_read))
    misses = _leased(store, CONTENT, misses, "url", planner, asof)
    aliased = checkpointed(batching.assign_aliases(batching.assign_batches(misses, batch_size)))
    return _remembered(store, CONTENT, planner, Plan(
        rejected=state.rejected_files(pending).select("url"),
        skipped=split.filter("on_disk").select("url"),
        hits=hits,
        open_items=aliased,
        requests=_keyed(batching.content_requests(aliased)),
    ))


PLACE = ["url", "owner", "repo", "ref", "path"]


def batched_content(plan: Plan, answers: DataFrame) -> DataFrame:
    """Items answered in batches or by the cache: place, key, outcome, error, is_hit and text.

    Items of a batch that failed as a whole have outcome "failed": they stay pending.
    """
    answered = responses.content_answers(plan.open_items, _answers_of(plan, answers)).withColumn(
        "error", responses.content_error()
    )
    outcome = responses.batched_outcome(F.col("error"), F.col("text"))
    fresh = answered.select(
        *PLACE,
        "key",
        F.when(F.col("batch_ok"), outcome).otherwise("failed").alias("outcome"),
        "error",
        F.lit(False).alias("is_hit"),
        "byte_size",
        "text",
    )
    content = F.get_json_object("body", "$.content")
    cached_error = F.coalesce(F.col("error"), F.when(F.coalesce(content, F.lit("")) == "", "no_content"))
    cached = plan.hits.select(
        *PLACE,
        "key",
        responses.batched_outcome(cached_error, content).alias("outcome"),
        cached_error.alias("error"),
        F.lit(True).alias("is_hit"),
        F.lit(None).cast("bigint").alias("byte_size"),
        text.decoded_text(content).alias("text"),
    )
    return fresh.unionByName(cached)


def single_error():
    """Error name of a single-file answer, NULL when there is content."""
    return (
        F.when(F.coalesce(F.col("is_folder"), F.lit(False)), "directory")
        .when(F.col("status") == 404, "not_found")
        .when(F.col("status").isNull() | ~F.col("status").between(200, 299), "error")
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("content").isNull(), "no_content")
    )


def single_content(wanted: DataFrame, singles: DataFrame, fetched: str = "truncated_rest") -> DataFrame:
    """Wanted items with their single-file answer; those without one stay pending.

    wanted: place, key, is_hit. singles: url, status, error, content (base64), is_folder; the
    latest answer of a URL counts. Content that cannot be decoded is an error.
    """
    named = responses.single_outcome(
        F.col("status"), F.col("error"), F.col("content"), F.col("is_folder")
    )
    order = ["answered_at", "content"] if "answered_at" in singles.columns else ["status", "content"]
    alone = last_wins(singles, "url", order).select(
        "url", named.alias("_named"), single_error().alias("error"), text.decoded_text(F.col("content")).alias("text")
    )
    found = F.col("_named") == "fetched"
    broken = found & F.col("text").isNull()
    outcome = F.when(broken, "error").when(found, fetched).otherwise(F.col("_named"))
    return wanted.join(alone, "url").select(
        *PLACE, "key", outcome.alias("outcome"), F.when(broken, "error").otherwise(F.col("error")).alias("error"),
        "is_hit", F.lit(None).cast("bigint").alias("byte_size"), "text",
    )


def content_entries(stored: DataFrame) -> DataFrame:
    """Cache entries of a run's stored content rows: texts and lasting errors, never truncated ones."""
    body = F.to_json(F.struct(
        text.encoded_text(F.col("text")).alias("content"), F.lit("base64").alias("encoding"),
        F.col("byte_size").alias("size"), "path",
    ))
    fresh = stored.filter(~F.col("is_hit") & cache.admit_content(F.col("error")))
    return fresh.select("key", F.when(F.col("error").isNull(), body).otherwise(error_body(F.col("error"))).alias("body"), "error")


def outcome_status(outcome):
    """Stored status of an outcome."""
    return F.when(outcome.isin("fetched", "skipped", "truncated_rest"), "fetched").otherwise(outcome)


def record_content(
    store: StateStore, plan: Plan, answers: DataFrame, singles: DataFrame, content_path: str, run: str, asof: str
) -> DataFrame:
    """Store text and statuses; returns the counters of the run.

    Answers are unpacked once, straight into the content table. What follows reads narrow
    columns of that table: texts are never shuffled or written twice. A killed run is repeated
    under its name and goes on behind the stages it has written; a finished one is refused.
    """
    operation = unfinished(store, run)

    def stored(outcomes: DataFrame, stage: str) -> DataFrame:
        rows = outcomes.withColumn("status", outcome_status(F.col("outcome")))
        return write_content_table(rows, content_path, run, stage, resume=True)

    batched = stored(batched_content(plan, answers), "batch")
    truncated = batched.filter(F.col("status") == "truncated")
    single = stored(single_content(truncated.select(*PLACE, "key", "is_hit"), singles), "single")
    return settle_content(store, plan, [batched, single], asof, operation)


def unfinished(store: StateStore, run: str) -> str:
    """The name under which a content run is committed; a run that is finished is refused."""
    operation = f"content-{run}"
    if store.done(operation):
        raise ValueError(f"run {run} is finished; take a new name")
    return operation


def settle_content(store: StateStore, plan: Plan, stored: list[DataFrame], asof: str, operation: str) -> DataFrame:
    """Statuses, cache entries and counters of stored content rows; every item of the plan is counted once."""

    def fixed(rows: DataFrame, outcome: str) -> DataFrame:
        return rows.select("url", F.lit(outcome).alias("outcome"), F.lit(False).alias("is_hit"))

    rows = reduce(DataFrame.unionByName, [r.filter("status <> 'truncated'") for r in stored])
    outcomes = rows.select("url", "outcome", "is_hit")
    handled = outcomes.filter("outcome <> 'failed'").unionByName(fixed(plan.skipped, "skipped"))
    updates = handled.select(
        "url",
        outcome_status(F.col("outcome")).alias("status"),
        F.lit(asof).cast("timestamp").alias("fetched_at"),
        F.lit(0).alias("seq"),
    )
    pending = plan.open_items.join(outcomes.select("url"), "url", "left_anti")
    failed = fixed(outcomes.filter("outcome = 'failed'"), "error")
    counters = checkpointed(audit.outcome_counts(
        handled.unionByName(fixed(plan.rejected, "error")).unionByName(failed).unionByName(fixed(pending, "pending"))
    ))
    commit = store.begin(operation)
    add_answers(commit, content_entries(rows.filter("status <> 'failed'")), CONTENT, asof)
    put(commit, "content_status", updates, "url")
    commit.publish()
    return counters


# --- metadata ----------------------------------------------------------------------------


def plan_metadata(
    store: StateStore,
    response_cache: DataFrame | None,
    asof: str,
    batch_size: int = batching.METADATA_BATCH,
    retry_errors: bool = False,
    skip_read: bool = False,
    planner: str | None = None,
) -> Plan:
    missing = state.repos_without_metadata(store.read("files"), store.read("repo_metadata"))
    keyed = missing.withColumn("key", keys.metadata_key(F.col("repo_key")))
    entries = cache.readable_entries(cached_answers(store, response_cache, METADATA), asof, skip_read, retry_errors)
    hits, misses = _cache_split(keyed, entries)
    misses = _leased(store, METADATA, misses, "repo_key", planner, asof)
    batched = checkpointed(batching.assign_batches(misses, batch_size))
    return _remembered(store, METADATA, planner, Plan(None, None, hits, batched, _keyed(batching.metadata_requests(batched))))


def record_metadata(store: StateStore, plan: Plan, answers: DataFrame, asof: str) -> DataFrame:
    """Store found repositories. Errors are not stored, so those stay pending."""
    answered = checkpointed(
        responses.metadata_answers(plan.open_items, _answers_of(plan, answers))
        .withColumn("error", responses.metadata_error())
        .select("repo_key", "key", "batch_ok", "error", "repo")
    )
    stored_columns = [f.name for f in store.read("repo_metadata").schema.fields if f.name not in ("repo_key", "fetched_at")]
    cached = plan.hits.withColumn(
        "_stored",
        F.from_json("body", schemas.STORED_METADATA),
    )
    fresh = responses.flatten_metadata(answered)
    # An empty cached object is neither stored nor an error.
    filled = F.coalesce(F.size(F.json_object_keys("body")) > 0, F.lit(False))
    known = cached.filter(F.col("error").isNull() & filled).select(
        "repo_key", *[F.col(f"_stored.{c}").alias(c) for c in stored_columns]
    )
    updates = (
        fresh.unionByName(known)
        .withColumn("fetched_at", F.lit(asof).cast("timestamp"))
        .withColumn("seq", F.lit(0))
    )

    fresh_outcome = F.when(F.col("error").isNull(), "fetched").otherwise("error")
    hit_outcome = F.when(F.col("error").isNotNull(), "error").when(filled, "fetched")
    outcomes = answered.select(fresh_outcome.alias("outcome"), F.lit(False).alias("is_hit")).unionByName(
        plan.hits.select(hit_outcome.alias("outcome"), F.lit(True).alias("is_hit"))
    )
    counters = checkpointed(audit.outcome_counts(outcomes.unionByName(_unanswered(plan, answers))))
    whole = F.to_json(F.struct(*responses.metadata_columns(F.col("repo"))), {"ignoreNullFields": "false"})
    body = F.when(F.col("error").isNull(), whole).otherwise(error_body(F.col("error")))
    commit = store.begin()
    add_answers(commit, answered.filter("batch_ok").select("key", body.alias("body"), "error"), METADATA, asof)
    put(commit, "repo_metadata", updates, "repo_key", state.upsert_metadata)
    commit.publish()
    return counters


# --- history -----------------------------------------------------------------------------


def plan_history(
    store: StateStore,
    response_cache: DataFrame | None,
    asof: str,
    batch_size: int = batching.HISTORY_BATCH,
    retry_errors: bool = False,
    skip_read: bool = False,
    planner: str | None = None,
) -> Plan:
    pending = state.files_without_history(store.read("files"), store.read("file_history"))
    parsed = state.parsed_files(pending)
    key = keys.history_key(F.col("owner"), F.col("repo"), F.col("path"))
    wanted = parsed.select(*PLACE, "seq", key.alias("key"))
    entries = cache.readable_entries(cached_answers(store, response_cache, HISTORY), asof, skip_read, retry_errors)
    hits, misses = _cache_split(wanted, entries)
    misses = _leased(store, HISTORY, misses, "url", planner, asof)
    aliased = checkpointed(batching.assign_aliases(batching.assign_batches(misses, batch_size)))
    return _remembered(store, HISTORY, planner, Plan(
        rejected=state.rejected_files(pending).select("url"),
        skipped=None,
        hits=hits,
        open_items=aliased,
        requests=_keyed(batching.history_requests(aliased)),
    ))


def record_history(store: StateStore, plan: Plan, answers: DataFrame, asof: str) -> DataFrame:
    """Store answered histories, also empty ones; errors stay pending."""
    answered = checkpointed(
        responses.history_answers(plan.open_items, _answers_of(plan, answers))
        .select("url", "key", "batch_ok", responses.history_error().alias("error"),
                commits.commit_records(F.col("nodes")).alias("commits"))
    )
    stored = F.from_json("body", schemas.STORED_HISTORY)
    no_commits = F.array().cast(schemas.STORED_HISTORY["commits"].dataType)
    known = plan.hits.filter(F.col("error").isNull()).select(
        "url", F.coalesce(stored["commits"], no_commits).alias("commits")
    )
    updates = (
        answered.filter("error IS NULL").select("url", "commits")
        .unionByName(known)
        .withColumn("fetched_at", F.lit(asof).cast("timestamp"))
        .withColumn("seq", F.lit(0))
    )

    def outcome(error):
        return F.when(error.isNull(), "fetched").otherwise("error")

    rejected = plan.rejected.select(F.lit("error").alias("outcome"), F.lit(False).alias("is_hit"))
    outcomes = (
        answered.select(outcome(F.col("error")).alias("outcome"), F.lit(False).alias("is_hit"))
        .unionByName(plan.hits.select(outcome(F.col("error")).alias("outcome"), F.lit(True).alias("is_hit")))
        .unionByName(rejected)
        .unionByName(_unanswered(plan, answers))
    )
    counters = checkpointed(audit.outcome_counts(outcomes))
    commit = store.begin()
    add_answers(commit, history_entries(answered.filter("batch_ok")), HISTORY, asof)
    put(commit, "file_history", updates, "url")
    commit.publish()
    return counters


def history_entries(answered: DataFrame) -> DataFrame:
    """Cache entries of answered histories, one for each key: refs share it, and commits go before errors."""
    body = F.when(F.col("error").isNull(), F.to_json(F.struct("commits"), {"ignoreNullFields": "false"})).otherwise(
        error_body(F.col("error"))
    )
    entries = answered.select("key", body.alias("body"), "error", F.col("error").isNull().alias("_found"))
    return last_wins(entries, "key", ["_found", "body"])


# --- comparison --------------------------------------------------------------------------


def compare(first: DataFrame, second: DataFrame, reported: DataFrame) -> dict[str, DataFrame]:
    """The comparison report: overlap per test, bands of growth, files the second missed."""
    overlap = audit.collection_overlap(first, second, reported)
    return {
        "overlap": overlap,
        "bands": audit.undercount_bands(overlap),
        "missed": audit.missed_by_second(first, second),
    }
