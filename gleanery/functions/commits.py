"""Column expressions that shape commit records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the commit format.
SHA_LENGTH = 7
MESSAGE_LENGTH = 80


def short_sha(oid: Column) -> Column:
    return F.left(oid, F.lit(SHA_LENGTH))


def first_line(message: Column) -> Column:
    """First line of a full message, cut to the stored length."""
    return F.left(F.substring_index(message, "\n", 1), F.lit(MESSAGE_LENGTH))


def headline(text: Column) -> Column:
    """Ready-made headline, empty when absent, cut to the stored length."""
    return F.left(F.coalesce(text, F.lit("")), F.lit(MESSAGE_LENGTH))


def commit_record(node: Column) -> Column:
    """Answer node as the stored commit struct."""
    return F.struct(
        short_sha(node["oid"]).alias("sha"),
        node["author"]["name"].alias("author"),
        node["committedDate"].alias("date"),
        headline(node["messageHeadline"]).alias("message"),
    )


def commit_records(nodes: Column) -> Column:
    """All answered nodes in source order; how many are asked for is up to the request."""
    return F.coalesce(F.transform(nodes, commit_record), F.array().cast("array<struct<sha:string,author:string,date:string,message:string>>"))
