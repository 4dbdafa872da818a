"""Stored views of the state tables, brought up to date from what has been added since."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.state_store import ConcurrentChange, StateStore


def refresh_hit_ranges(store: StateStore) -> DataFrame:
    """The distinct size ranges of every URL that was hit, url, size_min and size_max, up to the last commit.

    Reads the hits of the commits since the last refresh; of the stored view, the rows of their
    URLs, to which the list of those is sent where it is short. Ranges and the commit they reach to are
    published together, so a killed refresh is repeated, and of two at a time one looks again.
    Ranges without bounds are left out, as audit.multi_range_hits does.
    """
    name = "hit_ranges"
    while True:
        commit = store.begin(reads=("hit_ranges", "view_progress"))
        reached = commit.read("view_progress").filter(F.col("view") == name).agg(F.max("version")).first()[0] or 0
        if reached and store.unchanged("search_hits", reached, commit.base):
            return commit.read(name)
        added = store.changes("search_hits", reached, commit.base)
        fresh = added.filter("size_min IS NOT NULL AND size_max IS NOT NULL").select("url", "size_min", "size_max").distinct()
        known = commit.read(name).join(fresh.select("url").distinct(), "url", "left_semi")
        commit.append(name, fresh.join(known, ["url", "size_min", "size_max"], "left_anti"))
        mark = store.spark.range(1).select(F.lit(name).alias("view"), F.lit(commit.base).alias("version"))
        commit.upsert("view_progress", mark, "version")
        try:
            commit.publish()
            return store.read(name)
        except ConcurrentChange:
            continue
