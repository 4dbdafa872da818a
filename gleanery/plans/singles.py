"""The three enrichment jobs with one answer per item, as plain calls give them.

They share the plans of the batched jobs: open_items says what to ask for. Their outcomes and fields
differ: any content counts, also empty text; metadata has all topics; history has author dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions import commits, text, urls
from ..operators import audit, responses, state
from ..operators.links import resolve_links
from ..operators.ordering import last_wins
from ..session import checkpointed
from ..sources.content_tree import write_content_table
from ..sources.state_store import StateStore
from . import jobs
from .jobs import PLACE, Plan


def _latest(singles: DataFrame, key: list[str], body: str) -> DataFrame:
    """One answer per key: the latest by answered_at, where there is such a column."""
    order = ["answered_at"] if "answered_at" in singles.columns else []
    return last_wins(singles, key, [*order, "status", body])


def _iso(time: Column) -> Column:
    """Times of single answers are stored with their offset spelled out."""
    return F.regexp_replace(time, "Z$", "+00:00")


# --- content -----------------------------------------------------------------------------

FILE = ["owner", "repo", "ref", "path"]


def link_requests(singles: DataFrame) -> DataFrame:
    """Places that landed link answers point at and that have not landed themselves: what to ask for next."""
    target = F.col("target")
    stops = singles.filter(F.coalesce(F.col("is_link"), F.lit(False)) & (target != "") & ~target.startswith("/"))
    ahead = stops.select("owner", "repo", "ref", urls.link_destination(F.col("path"), target).alias("path")).distinct()
    return ahead.join(singles.select(*FILE), FILE, "left_anti")


def _followed(singles: DataFrame) -> DataFrame:
    """Answer of each place once links are followed; a chain that leaves what has landed has none yet."""
    is_link = F.coalesce(F.col("is_link"), F.lit(False))
    tree = F.to_json(F.array("owner", "repo", "ref"))
    ends = resolve_links(
        singles.select(tree.alias("repo_key"), "path", F.when(is_link, F.coalesce("target", F.lit(""))).alias("target"))
    ).filter("status <> 'not_found'")
    answer = F.struct("status", "error", "content", "is_folder")
    final = singles.filter(~is_link).select(tree.alias("repo_key"), F.col("path").alias("final_path"), answer.alias("_answer"))
    named = F.when(F.col("status") == "too_deep", "error").when(F.col("status") != "resolved", F.col("status"))
    parts = F.from_json("repo_key", "array<string>")
    return ends.join(final, ["repo_key", "final_path"], "left").select(
        *[parts[i].alias(n) for i, n in enumerate(("owner", "repo", "ref"))],
        "path",
        # A cycle is a failed call, a link out of the repository an answer without content.
        F.when(named == "error", 500).when(named.isNotNull(), 200).otherwise(F.col("_answer.status")).alias("status"),
        F.coalesce(named, F.col("_answer.error")).alias("error"),
        F.col("_answer.content").alias("content"),
        F.col("_answer.is_folder").alias("is_folder"),
    )


def record_content(
    store: StateStore, plan: Plan, singles: DataFrame, content_path: str, run: str, asof: str
) -> DataFrame:
    """Store single-file answers; returns the counters of the run.

    singles: owner, repo, ref, path, status, error, content (base64), is_folder, is_link, target.
    """
    operation = jobs.unfinished(store, run)
    landed = checkpointed(_followed(_latest(singles, FILE, "content")))
    wanted = plan.open_items.select(*PLACE, "key").withColumn("is_hit", F.lit(False))
    answers = wanted.select("url", *FILE).join(landed, FILE).select("url", "status", "error", "content", "is_folder")
    fresh = jobs.single_content(wanted, answers, fetched="fetched")
    content = F.get_json_object("body", "$.content")
    cached = plan.hits.select(
        *PLACE,
        "key",
        F.when(content.isNotNull(), "fetched").otherwise("not_found").alias("outcome"),
        F.col("error"),
        F.lit(True).alias("is_hit"),
        F.lit(None).cast("bigint").alias("byte_size"),
        text.decoded_text(content).alias("text"),
    )
    rows = fresh.unionByName(cached).withColumn("status", jobs.outcome_status(F.col("outcome")))
    stored = write_content_table(rows, content_path, run, "single", resume=True)
    return jobs.settle_content(store, plan, [stored], asof, operation)


# --- metadata and history ----------------------------------------------------------------


def _pending(plan: Plan, answered: DataFrame, key: str) -> DataFrame:
    return plan.open_items.join(answered.select(key), key, "left_anti").select(
        F.lit("pending").alias("outcome"), F.lit(False).alias("is_hit")
    )


def _error(parsed: Column) -> Column:
    """not_found is remembered; other failures are asked for again."""
    found = F.col("status").between(200, 299) & parsed.isNotNull()
    return F.when(F.col("status") == 404, "not_found").when(~F.coalesce(found, F.lit(False)), "error")


def _settled(plan: Plan, answered: DataFrame, key: str) -> DataFrame:
    """Outcomes of all items of a plan: answered, cached, pending, rejected."""
    named = F.when(F.col("error").isNull(), "fetched").otherwise("error").alias("outcome")
    outcomes = (
        answered.select(named, F.lit(False).alias("is_hit"))
        .unionByName(plan.hits.select(named, F.lit(True).alias("is_hit")))
        .unionByName(_pending(plan, answered, key))
    )
    if plan.rejected is None:
        return outcomes
    return outcomes.unionByName(plan.rejected.select(F.lit("error").alias("outcome"), F.lit(False).alias("is_hit")))


def _metadata(repo: Column) -> Column:
    return F.struct(
        repo["stargazers_count"].alias("stars"),
        repo["forks_count"].alias("forks"),
        repo["watchers_count"].alias("watchers"),
        repo["language"].alias("language"),
        F.coalesce(repo["topics"], F.array().cast("array<string>")).alias("topics"),
        *[_iso(repo[c]).alias(c) for c in ("created_at", "updated_at", "pushed_at")],
        repo["default_branch"].alias("default_branch"),
        repo["license"]["spdx_id"].alias("license"),
        repo["description"].alias("description"),
    )


def _record(store, plan, answered, key, table, endpoint, stored: StructType, asof, upsert=None) -> DataFrame:
    """Store found rows and cache entries of answered (key column, key, error, found struct)."""
    kept = plan.hits.filter("error IS NULL").select(key, F.from_json("body", stored).alias("found"))
    found = answered.filter("error IS NULL").select(key, "found").unionByName(kept)
    updates = found.select(key, "found.*", F.lit(asof).cast("timestamp").alias("fetched_at"), F.lit(0).alias("seq"))
    counters = checkpointed(audit.outcome_counts(_settled(plan, answered, key)))
    body = F.to_json("found", {"ignoreNullFields": "false"})
    lasting = answered.filter("error IS NULL OR error = 'not_found'").select(
        "key",
        F.when(F.col("error").isNull(), body).otherwise(jobs.error_body(F.col("error"))).alias("body"),
        "error",
        F.col("error").isNull().alias("_found"),
    )
    commit = store.begin()
    jobs.add_answers(commit, last_wins(lasting, "key", ["_found", "body"]), endpoint, asof)
    jobs.put(commit, table, updates, key, upsert)
    commit.publish()
    return counters


def record_metadata(store: StateStore, plan: Plan, singles: DataFrame, asof: str) -> DataFrame:
    """Store single repository answers: repo_key, status, body. Returns the counters."""
    parsed = F.from_json("body", schemas.SINGLE_REPO)
    latest = _latest(singles, ["repo_key"], "body").select("repo_key", _error(parsed).alias("error"), parsed.alias("_repo"))
    answered = checkpointed(
        plan.open_items.select("repo_key", "key").join(latest, "repo_key")
        .select("repo_key", "key", "error", _metadata(F.col("_repo")).alias("found"))
    )
    return _record(
        store, plan, answered, "repo_key", "repo_metadata", jobs.METADATA, schemas.STORED_METADATA, asof, state.upsert_metadata
    )


def record_history(store: StateStore, plan: Plan, singles: DataFrame, asof: str) -> DataFrame:
    """Store single history answers: url, status, body (a JSON list of commits). Returns the counters."""
    parsed = F.from_json("body", schemas.SINGLE_COMMITS)
    listed = F.transform(parsed, lambda c: F.struct(
        commits.short_sha(c["sha"]).alias("sha"),
        c["commit"]["author"]["name"].alias("author"),
        _iso(c["commit"]["author"]["date"]).alias("date"),
        commits.first_line(c["commit"]["message"]).alias("message"),
    ))
    latest = _latest(singles, ["url"], "body").select("url", _error(parsed).alias("error"), F.struct(listed.alias("commits")).alias("found"))
    answered = checkpointed(plan.open_items.select("url", "key").join(latest, "url").select("url", "key", "error", "found"))
    return _record(store, plan, answered, "url", "file_history", jobs.HISTORY, schemas.STORED_HISTORY, asof)
