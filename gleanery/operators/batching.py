"""Batched requests: numbering, aliases, grouping and request text.

A batch holds at most `size` items, so every group and window keyed by batch_id is small
however large one repository is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import with_position

# Items per request.
CONTENT_BATCH = 50
METADATA_BATCH = 50
HISTORY_BATCH = 5

# The request format, by level.
REQUEST_OPEN = "query {\n"
REQUEST_CLOSE = "\n}"
REPO_CLOSE = "\n  }"
BLOB_FIELDS = "      ... on Blob { text byteSize isTruncated }\n"
COMMIT_OPEN = "      ... on Commit {\n"
HISTORY_FIELDS = "          nodes { oid messageHeadline committedDate author { name } }\n"
METADATA_FIELDS = (
    "    stargazerCount\n"
    "    forkCount\n"
    "    watchers { totalCount }\n"
    "    primaryLanguage { name }\n"
    "    repositoryTopics(first: 20) { nodes { topic { name } } }\n"
    "    createdAt\n"
    "    updatedAt\n"
    "    pushedAt\n"
    "    defaultBranchRef { name }\n"
    "    licenseInfo { spdxId }\n"
    "    description"
)


def assign_batches(pending: DataFrame, size: int, order: str = "seq") -> DataFrame:
    """batch_id and pos: consecutive runs of `size` rows in pending order."""
    return (
        with_position(pending, order, "_position")
        .withColumn("batch_id", F.expr(f"_position div {size}"))
        .withColumn("pos", (F.col("_position") % size).cast("int"))
        .drop("_position")
    )


def assign_aliases(batched: DataFrame) -> DataFrame:
    """Alias numbers inside each batch, by first appearance.

    repo_no counts repositories of the batch, ref_no refs of a repository and file_no files
    of a ref. One shuffle by batch serves all windows.
    """
    repo = Window.partitionBy("batch_id", "owner", "repo")
    ref = Window.partitionBy("batch_id", "owner", "repo", "ref")
    numbered = (
        batched.repartition("batch_id")
        .withColumn("_repo_first", F.min("pos").over(repo))
        .withColumn("_ref_first", F.min("pos").over(ref))
        .withColumn(
            "repo_no",
            F.dense_rank().over(Window.partitionBy("batch_id").orderBy("_repo_first")) - 1,
        )
        .withColumn("ref_no", F.dense_rank().over(repo.orderBy("_ref_first")) - 1)
        .withColumn("file_no", F.row_number().over(ref.orderBy("pos")) - 1)
    )
    return numbered.drop("_repo_first", "_ref_first")


def repo_alias(number: Column) -> Column:
    return F.concat(F.lit("r"), number.cast("string"))


def ref_alias(number: Column) -> Column:
    return F.concat(F.lit("ref"), number.cast("string"))


def file_alias(number: Column) -> Column:
    return F.concat(F.lit("f"), number.cast("string"))


def quoted(text: Column) -> Column:
    """Text inside double quotes of a request: backslashes first, then quotes."""
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def _stacked(number: Column, block: Column) -> Column:
    """Blocks of a group in the order of their number, one under the other."""
    ordered = F.array_sort(F.collect_list(F.struct(number.alias("no"), block.alias("block"))))
    return F.array_join(F.transform(ordered, lambda entry: entry["block"]), "\n")


def _repo_block(body: Column) -> Column:
    return F.concat(
        F.lit("  "),
        repo_alias(F.col("repo_no")),
        F.lit(": repository(owner: "),
        quoted(F.col("owner")),
        F.lit(", name: "),
        quoted(F.col("repo")),
        F.lit(") {\n"),
        body,
        F.lit(REPO_CLOSE),
    )


def _request(blocks: DataFrame) -> DataFrame:
    text = F.concat(
        F.lit(REQUEST_OPEN), _stacked(F.col("repo_no"), F.col("block")), F.lit(REQUEST_CLOSE)
    )
    return blocks.groupBy("batch_id").agg(text.alias("request"))


def group_requests(aliased: DataFrame) -> DataFrame:
    """One row per batch and repository with its items in order."""
    item = F.struct("pos", "ref", "path")
    return aliased.groupBy("batch_id", "repo_no", "owner", "repo").agg(
        F.array_sort(F.collect_list(item)).alias("items")
    )


def content_requests(aliased: DataFrame) -> DataFrame:
    """Request text of each content batch."""
    expression = quoted(F.concat_ws(":", F.col("ref"), F.col("path")))
    line = F.concat(
        F.lit("    "),
        file_alias(F.col("pos")),
        F.lit(": object(expression: "),
        expression,
        F.lit(") {\n" + BLOB_FIELDS + "    }"),
    )
    blocks = aliased.groupBy("batch_id", "repo_no", "owner", "repo").agg(
        _stacked(F.col("pos"), line).alias("files")
    )
    return _request(blocks.withColumn("block", _repo_block(F.col("files"))))


def history_requests(aliased: DataFrame) -> DataFrame:
    """Request text of each history batch: repositories, then refs, then files."""
    line = F.concat(
        F.lit("        "),
        file_alias(F.col("file_no")),
        F.lit(": history(first: 100, path: "),
        quoted(F.col("path")),
        F.lit(") {\n" + HISTORY_FIELDS + "        }"),
    )
    refs = aliased.groupBy("batch_id", "repo_no", "owner", "repo", "ref_no", "ref").agg(
        _stacked(F.col("file_no"), line).alias("files")
    )
    ref_block = F.concat(
        F.lit("    "),
        ref_alias(F.col("ref_no")),
        F.lit(": object(expression: "),
        quoted(F.col("ref")),
        F.lit(") {\n" + COMMIT_OPEN),
        F.col("files"),
        F.lit("\n      }\n    }"),
    )
    repos = refs.groupBy("batch_id", "repo_no", "owner", "repo").agg(
        _stacked(F.col("ref_no"), ref_block).alias("refs")
    )
    return _request(repos.withColumn("block", _repo_block(F.col("refs"))))


def metadata_requests(batched: DataFrame) -> DataFrame:
    """Request text of each metadata batch: one block per repository key."""
    owner = F.substring_index("repo_key", "/", 1)
    repo = F.substring(F.col("repo_key"), F.length(owner) + 2, F.length("repo_key"))
    blocks = batched.select(
        "batch_id", F.col("pos").alias("repo_no"), owner.alias("owner"), repo.alias("repo")
    )
    return _request(blocks.withColumn("block", _repo_block(F.lit(METADATA_FIELDS))))
