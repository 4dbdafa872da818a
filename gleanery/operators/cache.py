"""The response cache as a table: lookup, admission, expiry and upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import last_wins
from .state import upsert

LIFETIME_DAYS = 30  # fixed value


def is_fresh(cached_at: Column, asof) -> Column:
    """Entries live for 30 days before asof."""
    limit = F.lit(asof).cast("timestamp") - F.expr(f"INTERVAL {LIFETIME_DAYS} DAYS")
    return cached_at > limit


def readable_entries(cache: DataFrame, asof, skip_read: bool = False, retry_errors: bool = False) -> DataFrame:
    """Entries a lookup may use.

    skip_read turns every lookup into a miss; retry_errors does so for cached errors.
    """
    usable = is_fresh(F.col("cached_at"), asof) & F.lit(not skip_read)
    if retry_errors:
        usable = usable & F.col("error").isNull()
    return cache.filter(usable)


def lookup(
    requests: DataFrame,
    cache: DataFrame,
    asof,
    skip_read: bool = False,
    retry_errors: bool = False,
    key: str = "key",
) -> DataFrame:
    """requests with is_hit and the cached columns of the latest usable entry.

    Entries are reduced to those asked for before bodies move.
    """
    entries = wanted_entries(requests, readable_entries(cache, asof, skip_read, retry_errors), key)
    entries = entries.withColumn("_found", F.lit(True))
    shared = [c for c in entries.columns if c != key and c in requests.columns]
    joined = requests.join(entries.drop(*shared), key, "left")
    return joined.withColumn("is_hit", F.coalesce("_found", F.lit(False))).drop("_found")


def hits(requests: DataFrame, entries: DataFrame, key: str = "key") -> DataFrame:
    """Requests with a usable entry, and what the latest one holds."""
    return requests.join(wanted_entries(requests, entries, key), key)


def wanted_entries(requests: DataFrame, entries: DataFrame, key: str = "key") -> DataFrame:
    """The latest entry of each key that is asked for; of equally old ones the one with the larger body."""
    asked = entries.join(requests.select(key), key, "left_semi")
    return last_wins(asked, key, ["cached_at", "body"])


def misses(requests: DataFrame, entries: DataFrame, key: str = "key") -> DataFrame:
    """Requests without one. Bodies are not read for this."""
    return requests.join(entries.select(key), key, "left_anti")


def admit_call(method: Column, status: Column) -> Column:
    """Single calls: successful GETs only."""
    return F.coalesce((method == "GET") & status.between(200, 299), F.lit(False))


def admit_batch(data: Column) -> Column:
    """Batched answers: those with data."""
    return data.isNotNull()


def admit_search(status: Column, n_items: Column, page: Column) -> Column:
    """Search pages: with items, or the first page; never a refused page (422)."""
    return F.coalesce(status.between(200, 299) & ((n_items > 0) | (page == 1)), F.lit(False))


def admit_content(error: Column) -> Column:
    """File answers: all but truncated ones, folders and failed calls."""
    return F.coalesce(~error.isin("truncated", "directory", "error"), F.lit(True))


def write_entries(cache: DataFrame, entries: DataFrame, order: str = "seq") -> DataFrame:
    """cache with the entries put in by key."""
    return upsert(cache, entries, "key", order)
