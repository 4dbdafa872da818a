"""State tables: what is known, what is missing, and how new rows get in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import urls
from .ordering import first_wins, replace_rows


# --- reading -----------------------------------------------------------------------------


def scan_files(files: DataFrame) -> DataFrame:
    """All URLs in insertion order."""
    return files.select("url", "seq").orderBy("seq")


def file_count(files: DataFrame) -> DataFrame:
    return files.agg(F.count(F.lit(1)).alias("n_files"))


def parsed_files(files: DataFrame) -> DataFrame:
    """File URLs split into owner, repo, ref and path; other URLs are left out."""
    return (
        files.filter(urls.is_file_url(F.col("url")))
        .withColumn("_segments", urls.url_segments(F.col("url")))
        .withColumns(urls.url_parts(F.col("_segments")))
        .drop("_segments")
    )


def rejected_files(files: DataFrame) -> DataFrame:
    """URLs no stage can handle; they get no status and stay pending."""
    return files.filter(~urls.is_file_url(F.col("url")))


def repo_keys(files: DataFrame) -> DataFrame:
    return files.filter(urls.on_host(F.col("url"))).withColumn("repo_key", urls.repo_key(F.col("url")))


def unique_repos(files: DataFrame) -> DataFrame:
    """One row per repository with the order of its first file."""
    return repo_keys(files).groupBy("repo_key").agg(F.min("seq").alias("seq"))


# --- what is missing ---------------------------------------------------------------------


def files_without_content(files: DataFrame, content_status: DataFrame) -> DataFrame:
    """Any status, also an error, counts as done."""
    return files.join(content_status.select("url"), "url", "left_anti")


def files_without_history(files: DataFrame, file_history: DataFrame) -> DataFrame:
    """An empty commit list counts as done."""
    return files.join(file_history.select("url"), "url", "left_anti")


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """NOT IN with its NULL rules, as a plain anti join.

    A NULL on the right empties the result; a NULL on the left passes only when the right
    side has no rows. Spark's own null-aware anti join always broadcasts the right side.
    """
    wanted = right.select(key)
    kept = left.join(wanted, key, "left_anti")
    right_null = wanted.filter(F.col(key).isNull()).exists()
    right_rows = wanted.exists()
    return kept.filter(~right_null & (F.col(key).isNotNull() | ~right_rows))


def repos_without_metadata(files: DataFrame, repo_metadata: DataFrame) -> DataFrame:
    return not_in(unique_repos(files), repo_metadata, "repo_key")


# --- writing -----------------------------------------------------------------------------


def new_files(files: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows with an unknown URL, the first of each URL.

    The known table is first reduced to the URLs that come in. Where these are few they are
    broadcast and the known table is only scanned; it is never shuffled whole against a small
    delivery. A null URL is new.
    """
    known = files.select("url").join(incoming.select("url"), "url", "left_semi")
    return first_wins(incoming, "url", "seq").join(known, "url", "left_anti")


def insert_files(files: DataFrame, incoming: DataFrame) -> DataFrame:
    """files plus the new rows; known URLs keep their row."""
    return files.unionByName(new_files(files, incoming), allowMissingColumns=True)


def upsert(current: DataFrame, updates: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """The last update of each key replaces the whole row; missing columns become NULL."""
    changes = updates
    for field in current.schema.fields:
        if field.name not in changes.columns:
            changes = changes.withColumn(field.name, F.lit(None).cast(field.dataType))
    return replace_rows(current, changes, key, order)


def upsert_metadata(current: DataFrame, updates: DataFrame, order: str = "seq") -> DataFrame:
    """As upsert; absent topics are an empty list."""
    empty = F.array().cast("array<string>")
    topics = F.coalesce(F.col("topics"), empty) if "topics" in updates.columns else empty
    return upsert(current, updates.withColumn("topics", topics), "repo_key", order)


def upsert_progress(current: DataFrame, updates: DataFrame, asof, order: str = "seq") -> DataFrame:
    """completed_at is the time of a completed update and goes back to NULL otherwise."""
    stamped = updates.withColumn(
        "completed_at", F.when(F.col("completed"), F.lit(asof).cast("timestamp"))
    ).withColumn("updated_at", F.lit(asof).cast("timestamp"))
    return upsert(current, stamped, "query", order)


def append_rows(current: DataFrame, extra: DataFrame) -> DataFrame:
    """Append without removing duplicates."""
    return current.unionByName(extra, allowMissingColumns=True)


def empty_state(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in schemas.STATE_TABLES.items()}
