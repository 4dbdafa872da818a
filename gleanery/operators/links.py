"""Following symbolic links inside repositories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import link_destination
from ..session import checkpointed


def _rounds(links: int) -> int:
    """Rounds after which only cycles are left: each doubles the links followed, and no chain has more than all."""
    return links.bit_length() + 1


def resolve_links(links: DataFrame) -> DataFrame:
    """Final path of every entry, with status.

    links: repo_key, path (unique together), target (NULL for a regular file, "" or an
    absolute path for a link that leaves the repository). Status is resolved, not_found
    (the chain leaves the table), unresolvable_symlink, or too_deep (a cycle).

    The full table is joined once, to see what each link's first stop is. After that only
    links take part: every round replaces the next stop of an open link by that stop's own
    next stop, so rounds grow with the logarithm of the longest chain. A stop shared by very
    many links is hot on one join side only, which AQE splits.
    """
    target = F.col("target")
    escapes = (target == "") | target.startswith("/")
    entries = links.select(
        "repo_key",
        "path",
        F.when(target.isNull(), "file").when(escapes, "unresolvable_symlink").otherwise("link").alias("kind"),
        F.when(target.isNotNull() & ~escapes, link_destination(F.col("path"), target)).alias("next"),
    )
    stops = entries.select("repo_key", F.col("path").alias("next"), F.col("kind").alias("next_kind"))
    reached = F.coalesce("next_kind", F.lit("not_found"))
    state = checkpointed(
        entries.filter(F.col("kind") == "link")
        .join(stops, ["repo_key", "next"], "left")
        .select("repo_key", "path", "next", F.when(reached != "link", reached).alias("kind"))
    )
    is_open = F.col("kind").isNull()
    for _ in range(_rounds(state.filter(is_open).count())):
        waiting = state.filter(is_open)
        if waiting.isEmpty():
            break
        ahead = state.select(
            "repo_key", F.col("path").alias("next"), F.col("next").alias("_next"), "kind"
        )
        moved = waiting.drop("kind").join(ahead, ["repo_key", "next"])
        moved = moved.select("repo_key", "path", F.col("_next").alias("next"), "kind")
        state = checkpointed(state.filter(~is_open).unionByName(moved))

    followed = state.select(
        "repo_key", "path", F.col("next").alias("final_path"), F.coalesce("kind", F.lit("too_deep")).alias("kind")
    )
    own = entries.filter(F.col("kind") != "link").select(
        "repo_key", "path", F.col("path").alias("final_path"), "kind"
    )
    at_file = F.col("kind") == "file"
    return own.unionByName(followed).select(
        "repo_key",
        "path",
        F.when(at_file, F.col("final_path")).alias("final_path"),
        F.when(at_file, "resolved").otherwise(F.col("kind")).alias("status"),
    )
