"""Landed answers: unpack, give each item its part, name the outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions import commits, text
from .batching import file_alias, ref_alias, repo_alias
from .ordering import last_wins

# Limits of the search service and of one page's retries.
PAGES_PER_QUERY = 10
ITEMS_PER_PAGE = 100
TRIES_PER_PAGE = 3


# --- search pages ------------------------------------------------------------------------


def search_items(pages: DataFrame) -> DataFrame:
    """One row per item of a landed search page; a page without items keeps one row."""
    return pages.select(
        "query", "page", "attempt", "total_count", F.posexplode_outer("items").alias("item_no", "item")
    ).select(
        "query",
        "page",
        "attempt",
        "total_count",
        "item_no",
        F.col("item.html_url").alias("url"),
        F.col("item.sha").alias("sha"),
        F.col("item.name").alias("name"),
        F.col("item.path").alias("path"),
        F.col("item.repository.full_name").alias("full_name"),
    )


def usable_pages(attempts: DataFrame, page_size: int = ITEMS_PER_PAGE) -> DataFrame:
    """Which attempt of which page belongs to a query's result.

    attempts: query, page, attempt, total_count, n_items (an attempt that is not there
    came back empty). A page counts with its first non-empty attempt; the walk over pages
    ends at the first page that stays empty, or whose empty attempt came when the items so
    far already reached what was expected. At most 30 attempts of a query are looked at.
    """
    seen = attempts.filter(
        (F.col("page") <= PAGES_PER_QUERY) & (F.col("attempt") <= TRIES_PER_PAGE)
    )
    filled = F.when(F.col("n_items") > 0, F.col("attempt"))
    per_page = seen.groupBy("query", "page").agg(
        F.min(filled).alias("attempt"),
        F.min_by("n_items", filled).alias("n_items"),
        F.min_by("total_count", "attempt").alias("page_total"),
    )
    by_page = Window.partitionBy("query").orderBy("page")
    before = by_page.rowsBetween(Window.unboundedPreceding, -1)
    up_to = by_page.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    walked = (
        per_page.withColumn("expected", F.first("page_total").over(up_to))
        .withColumn("prior", F.coalesce(F.sum("n_items").over(before), F.lit(0)))
        .withColumn("place", F.row_number().over(by_page))
    )
    expected = F.coalesce("expected", F.lit(0))  # an answer without a total promises nothing
    enough = F.col("prior") >= F.least(expected, F.col("page") * page_size)
    ends = (
        F.col("attempt").isNull()
        | (F.col("place") != F.col("page"))
        | ((F.col("attempt") > 1) & enough)
    )
    return (
        walked.withColumn("_ended", F.max(ends.cast("int")).over(up_to))
        .filter(F.col("_ended") == 0)
        .select("query", "page", "attempt")
    )


def assemble_pages(items: DataFrame, page_size: int = ITEMS_PER_PAGE) -> DataFrame:
    """Items of all landed page attempts, with in_walk: whether a walk over the pages would have taken them.

    items: one row per item with query, page, attempt, total_count, url (NULL on the one
    row of an empty attempt). The join partner has at most ten rows per query. Nothing that has
    landed is dropped.
    """
    attempts = items.groupBy("query", "page", "attempt").agg(
        F.count("url").alias("n_items"), F.max("total_count").alias("total_count")
    )
    usable = usable_pages(attempts, page_size)
    marked = usable.withColumn("_walked", F.lit(True))
    joined = items.filter(F.col("url").isNotNull()).join(marked, ["query", "page", "attempt"], "left")
    return joined.withColumn("in_walk", F.coalesce("_walked", F.lit(False))).drop("_walked")


# --- batched answers ---------------------------------------------------------------------


def _per_item(requested: DataFrame, answers: DataFrame, body: StructType, found) -> DataFrame:
    """Give every item of an answered batch its part of the body.

    A batch's items travel as one small array, so the join has one row per batch on either
    side and a body is never copied per item. batch_ok is false where the body has no data.
    """
    columns = [F.col(name) for name in requested.columns if name != "batch_id"]
    batches = requested.groupBy("batch_id").agg(F.collect_list(F.struct(*columns)).alias("_items"))
    parsed = answers.select("batch_id", F.from_json("body", body)["data"].alias("_data"))
    each = F.transform(
        "_items",
        lambda item: F.struct(
            item.alias("item"),
            F.col("_data").isNotNull().alias("batch_ok"),
            found(F.col("_data"), item).alias("found"),
        ),
    )
    return (
        batches.join(parsed, "batch_id")
        .select("batch_id", F.inline(each))
        .select("batch_id", "item.*", "batch_ok", "found.*")
    )


def latest_answers(answers: DataFrame) -> DataFrame:
    """One answer per request_key: the latest by answered_at, where there is such a column, then by body."""
    order = ["answered_at", "body"] if "answered_at" in answers.columns else ["body"]
    return last_wins(answers, "request_key", order).select("request_key", "body")


def content_answers(aliased: DataFrame, answers: DataFrame) -> DataFrame:
    """aliased: items with batch_id, repo_no, pos; answers: batch_id, body."""

    def found(data: Column, item: Column) -> Column:
        repo = F.try_element_at(data, repo_alias(item["repo_no"]))
        blob = F.try_element_at(repo, file_alias(item["pos"]))
        return F.struct(
            repo.isNotNull().alias("repo_found"),
            blob.isNotNull().alias("blob_found"),
            F.coalesce(blob["isTruncated"], F.lit(False)).alias("is_truncated"),
            blob["text"].alias("text"),
            F.coalesce(blob["byteSize"], F.lit(0)).alias("byte_size"),
        )

    return _per_item(aliased, answers, schemas.CONTENT_BODY, found)


def history_answers(aliased: DataFrame, answers: DataFrame) -> DataFrame:
    """aliased: items with batch_id, repo_no, ref_no, file_no; answers: batch_id, body."""

    def found(data: Column, item: Column) -> Column:
        repo = F.try_element_at(data, repo_alias(item["repo_no"]))
        ref = F.try_element_at(repo, ref_alias(item["ref_no"]))
        history = F.try_element_at(ref, file_alias(item["file_no"]))
        return F.struct(
            repo.isNotNull().alias("repo_found"),
            ref.isNotNull().alias("ref_found"),
            history.isNotNull().alias("history_found"),
            history["nodes"].alias("nodes"),
        )

    return _per_item(aliased, answers, schemas.HISTORY_BODY, found)


def metadata_answers(batched: DataFrame, answers: DataFrame) -> DataFrame:
    """batched: repo_key with batch_id, pos; answers: batch_id, body."""

    def found(data: Column, item: Column) -> Column:
        return F.struct(F.try_element_at(data, repo_alias(item["pos"])).alias("repo"))

    return _per_item(batched, answers, schemas.METADATA_BODY, found).withColumn(
        "repo_found", F.col("repo").isNotNull()
    )


# --- outcomes ----------------------------------------------------------------------------


def content_error() -> Column:
    """Error name of a batched content answer, NULL when there is text."""
    return (
        F.when(~F.col("batch_ok"), "error")
        .when(~F.col("repo_found") | ~F.col("blob_found"), "not_found")
        .when(F.col("is_truncated"), "truncated")
        .when(F.col("text").isNull(), "no_content")
    )


def history_error() -> Column:
    return (
        F.when(~F.col("batch_ok"), "error")
        .when(~F.col("repo_found"), "not_found")
        .when(~F.col("ref_found"), "bad_ref")
        .when(~F.col("history_found"), "no_history")
    )


def metadata_error() -> Column:
    return F.when(~F.col("batch_ok"), "error").when(~F.col("repo_found"), "not_found")


def batched_outcome(error: Column, content: Column) -> Column:
    """Outcome of a batched content answer; "truncated" goes on to the single-file stage.

    An empty text is an error here, unlike in single_outcome.
    """
    return (
        F.when(error == "truncated", "truncated")
        .when(error.isin("not_found", "unresolvable_symlink"), "not_found")
        .when(error.isNotNull() | content.isNull() | (content == ""), "error")
        .otherwise("fetched")
    )


def single_outcome(status: Column, error: Column, content: Column, is_folder: Column) -> Column:
    """Outcome of a single-file answer: any content, even empty, counts as fetched.

    A named error in the answer (or no content) means not found, as do 404 and a folder;
    every other failure is an error.
    """
    return (
        F.when((status == 404) | F.coalesce(is_folder, F.lit(False)), "not_found")
        .when(status.isNull() | ~status.between(200, 299), "error")
        .when(error.isNull() & content.isNotNull(), "fetched")
        .otherwise("not_found")
    )


# --- flattening --------------------------------------------------------------------------


def metadata_columns(repo: Column) -> list[Column]:
    """The eleven stored columns of a repository answer, NULL-safe at every level."""
    nodes = F.filter(repo["repositoryTopics"]["nodes"], lambda n: n["topic"].isNotNull())
    topics = F.transform(nodes, lambda n: n["topic"]["name"])
    return [
        repo["stargazerCount"].alias("stars"),
        repo["forkCount"].alias("forks"),
        repo["watchers"]["totalCount"].alias("watchers"),
        repo["primaryLanguage"]["name"].alias("language"),
        F.coalesce(topics, F.array().cast("array<string>")).alias("topics"),
        repo["createdAt"].alias("created_at"),
        repo["updatedAt"].alias("updated_at"),
        repo["pushedAt"].alias("pushed_at"),
        repo["defaultBranchRef"]["name"].alias("default_branch"),
        repo["licenseInfo"]["spdxId"].alias("license"),
        repo["description"].alias("description"),
    ]


def flatten_metadata(answers: DataFrame, repo: str = "repo") -> DataFrame:
    """Found repositories as rows of the metadata table."""
    return answers.filter(F.col(repo).isNotNull()).select("repo_key", *metadata_columns(F.col(repo)))


def flatten_history(answers: DataFrame) -> DataFrame:
    """Answered histories as rows of the history table (commits may be empty)."""
    return answers.filter(history_error().isNull()).select(
        "url", commits.commit_records(F.col("nodes")).alias("commits")
    )


def history_rows(nodes: DataFrame) -> DataFrame:
    """Commit fields of single-file answers: author date, first message line."""
    return nodes.select(
        "url",
        "ord",
        commits.short_sha(F.col("oid")).alias("sha"),
        "author",
        F.col("committed_at").alias("date"),
        commits.first_line(F.col("message")).alias("message"),
    )


def decoded_content(rows: DataFrame, content: str = "content") -> DataFrame:
    """Decode base64 content; what cannot be decoded has a NULL text."""
    return rows.withColumn("text", text.decoded_text(F.col(content)))


# --- raw response log --------------------------------------------------------------------


def envelope(log: DataFrame) -> DataFrame:
    """status, body, etag, link of logged answers; an empty body is an empty object."""
    raw = F.when(F.coalesce(F.length("body"), F.lit(0)) == 0, F.lit("{}")).otherwise(F.col("body"))
    return log.withColumn("body", F.try_parse_json(raw))


def rest_disposition(status: Column, body_text: Column) -> Column:
    """What a single-call answer means for the caller."""
    limited = (status == 429) | (
        (status == 403) & F.contains(F.lower(F.coalesce(body_text, F.lit(""))), F.lit("rate limit"))
    )
    return (
        F.when(limited, "rate_limited")
        .when(status >= 500, "retryable")
        .when(status.between(200, 299), "success")
        .otherwise("terminal")
    )


def batch_disposition(status: Column) -> Column:
    """The same for a batched answer, where every 403 is a rate limit."""
    return (
        F.when(status == 200, "success")
        .when(status.isin(429, 403), "rate_limited")
        .when(status >= 500, "retryable")
        .otherwise("terminal")
    )


def retry_after_seconds(header: Column) -> Column:
    """Numeric wait of the header, NULL when it is a date or absent."""
    return header.try_cast("double")
