"""Free calls: cached ones are answered from the state, the others asked for, recorded and cached."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from ..operators import cache, responses
from ..operators.ordering import last_wins
from ..session import checkpointed
from ..sources.state_store import StateStore
from . import jobs

API, BATCH = "api", "graphql"


@dataclass(frozen=True)
class Calls:
    """hits have their cached body; requests, one for each key, are to be sent."""

    wanted: DataFrame
    hits: DataFrame
    requests: DataFrame
    endpoint: str


def _split(store: StateStore, wanted: DataFrame, endpoint: str, asof: str, skip_read: bool) -> Calls:
    wanted = checkpointed(wanted)
    entries = cache.readable_entries(jobs.cached_answers(store, None, endpoint), asof, skip_read)
    readable = wanted.filter("reads_cache")
    hits = cache.hits(readable, entries)
    misses = cache.misses(readable, entries).unionByName(wanted.filter("NOT reads_cache"))
    return Calls(wanted, hits, checkpointed(misses), endpoint)


def plan_calls(store: StateStore, calls: DataFrame, asof: str, skip_read: bool = False) -> Calls:
    """Single calls. calls: call_id, method, endpoint, params (a map of text). Only GETs read the cache."""
    params = F.coalesce("params", F.create_map().cast("map<string,string>"))
    key = keys.call_key(F.col("endpoint"), params)
    wanted = calls.select("call_id", "method", F.col("endpoint"), params.alias("params"), key.alias("key"))
    gets = F.coalesce(F.col("method") == "GET", F.lit(False))
    return _split(store, wanted.withColumn("reads_cache", gets), API, asof, skip_read)


def plan_batches(store: StateStore, calls: DataFrame, asof: str, skip_read: bool = False) -> Calls:
    """Batched calls. calls: call_id, request, variables (ready JSON, or null)."""
    key = keys.batch_key(F.col("request"), F.coalesce("variables", F.lit("{}")))
    wanted = calls.select("call_id", F.lit("POST").alias("method"), "request", "variables", key.alias("key"))
    return _split(store, wanted.withColumn("reads_cache", F.lit(True)), BATCH, asof, skip_read)


def record_calls(store: StateStore, plan: Calls, log: DataFrame, asof: str) -> DataFrame:
    """Store what may be cached; returns every call with its answer.

    log: key, method, answered_at, status, body, etag, link, and every try of a call; the latest one
    counts. Rows: call_id, is_hit, disposition, status, body (JSON text), etag, link. A call without
    an answer is pending. A call of another method is matched by key and method, so that the answer
    to a GET is not taken for it.
    """
    single = plan.endpoint == API
    latest = last_wins(log, ["key", "method"], ["answered_at", "status", "body"])
    disposition = (
        responses.rest_disposition(F.col("status"), F.col("_raw")) if single else responses.batch_disposition(F.col("status"))
    )
    known = responses.envelope(latest.withColumn("_raw", F.col("body"))).withColumn("disposition", disposition)
    text = F.coalesce(F.to_json("body"), F.col("_raw"))
    answers = checkpointed(
        known.join(plan.requests.select("key", "method").distinct(), ["key", "method"], "left_semi").select(
            "key", "method", "disposition", "status", text.alias("body"), "etag", "link",
            (cache.admit_call(F.col("method"), F.col("status")) if single
             else (F.col("status") == 200) & cache.admit_batch(F.try_variant_get("body", "$.data", "variant"))).alias("_admitted"),
        )
    )
    packed = F.to_json(F.struct("status", "body", "etag", "link"), {"ignoreNullFields": "false"})
    admitted = answers.filter("_admitted").select("key", packed.alias("body"), F.lit(None).cast("string").alias("error"))
    jobs.add_answers(store, admitted, plan.endpoint, asof)

    shown = ["call_id", "is_hit", "disposition", "status", "body", "etag", "link"]
    asked = plan.requests.select("call_id", "key", "method").join(answers, ["key", "method"], "left")
    fresh = asked.withColumn("is_hit", F.lit(False)).withColumn("disposition", F.coalesce("disposition", F.lit("pending")))
    unpacked = plan.hits.select("call_id", F.from_json("body", "status int, body string, etag string, link string").alias("_a"))
    cached = unpacked.select("call_id", F.lit(True).alias("is_hit"), F.lit("success").alias("disposition"), "_a.*")
    return fresh.select(*shown).unionByName(cached.select(*shown))
