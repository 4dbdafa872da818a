"""Reports over hits, histories, request logs and pairs of collections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import base_query
from .ranges import join_in_range


def multi_range_hits(hits: DataFrame) -> DataFrame:
    """URLs that came back from several size ranges, most ranges first.

    Equal (url, range) pairs merge before anything is gathered by URL, so a URL hit very
    often costs no more than its distinct ranges.
    """
    ranges = (
        hits.filter(F.col("size_min").isNotNull() & F.col("size_max").isNotNull())
        .select(
            "url",
            F.concat_ws("..", F.col("size_min").cast("string"), F.col("size_max").cast("string")).alias("range"),
        )
        .distinct()
    )
    return (
        ranges.groupBy("url")
        .agg(
            F.count(F.lit(1)).alias("range_count"),
            F.array_join(F.array_sort(F.collect_list("range")), ",").alias("ranges"),
        )
        .filter(F.col("range_count") > 1)
        .orderBy(F.col("range_count").desc(), F.col("url").asc())
    )


def sample_urls(files: DataFrame, n: int = 10) -> DataFrame:
    """The first n URLs; the limit is the report itself."""
    return files.select("url", "seq").orderBy("seq").limit(n)


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Counters of one stage run over its outcome column."""

    def counted(*names: str):
        return F.count_if(F.col("outcome").isin(*names))

    return outcomes.agg(
        counted("fetched").alias("fetched"),
        counted("skipped").alias("skipped"),
        counted("not_found").alias("not_found"),
        counted("error").alias("errors"),
        counted("truncated_rest").alias("truncated_rest"),
        counted("pending").alias("pending"),
        F.count_if(F.col("is_hit")).alias("cache_hits"),
    )


def request_telemetry(log: DataFrame) -> DataFrame:
    """Counters of a request log: status, started_at, elapsed_ms."""
    status = F.col("status")
    started = F.unix_micros(F.col("started_at").cast("timestamp"))
    micros = F.max(started) - F.min(started)
    n = F.count(F.lit(1))
    return log.agg(
        n.alias("queries"),
        F.count_if(status >= 500).alias("retries"),
        F.count_if(status.isin(403, 429)).alias("rate_limit_hits"),
        F.coalesce(F.avg("elapsed_ms"), F.lit(0.0)).alias("avg_ms"),
        F.coalesce(n * 1e6 / F.nullif(micros, F.lit(0)), F.lit(0.0)).alias("queries_per_sec"),
    )


def history_summary(commits: DataFrame) -> DataFrame:
    """First and last commit, authors and commits per file; commits: url, date, author."""
    return commits.groupBy("url").agg(
        F.min("date").alias("first_commit"),
        F.max("date").alias("last_commit"),
        F.count_distinct("author").alias("n_authors"),
        F.count(F.lit(1)).alias("n_commits"),
    )


def exploded_commits(file_history: DataFrame) -> DataFrame:
    """Stored histories as one row per commit; files without commits drop out."""
    return file_history.select("url", F.inline("commits"))


# --- comparing collections ---------------------------------------------------------------


def collection_overlap(first: DataFrame, second: DataFrame, reported: DataFrame) -> DataFrame:
    """Per test: sizes, share of the first collection found by the second, and growth.

    first, second: test, url. reported: test, api (what the service claims).
    """
    left = first.select("test", "url").distinct().withColumn("in_a", F.lit(1))
    right = second.select("test", "url").distinct().withColumn("in_b", F.lit(1))
    counts = (
        left.join(right, ["test", "url"], "full_outer")
        .groupBy("test")
        .agg(
            F.count("in_a").alias("n_a"),
            F.count("in_b").alias("n_b"),
            F.count_if(F.col("in_a").isNotNull() & F.col("in_b").isNotNull()).alias("n_both"),
        )
    )
    return counts.join(reported, "test", "left").select("test", "api", "n_a", "n_b", "n_both", *_growth())


def _percent(part, whole, less: int = 0):
    return F.round((part / F.nullif(whole, F.lit(0)) - less) * 100, 2)


def _growth():
    a, b, api = F.col("n_a"), F.col("n_b"), F.col("api")
    return [
        _percent(F.col("n_both"), a).alias("a_in_b_pct"),
        _percent(b, a, 1).alias("b_over_a_pct"),
        _percent(a, api, 1).alias("a_over_api_pct"),
        _percent(b, api, 1).alias("b_over_api_pct"),
    ]


def missed_by_second(first: DataFrame, second: DataFrame) -> DataFrame:
    """Files of the first collection the second never saw."""
    left = first.select("test", "url").distinct()
    return left.join(second.select("test", "url"), ["test", "url"], "left_anti")


# Bounds of the reported-size bands.
BANDS = (("<100", 0, 99), ("100-1,000", 100, 999), ("1,000-7,000", 1000, 6999), (">=7,000", 7000, None))


def undercount_bands(overlap: DataFrame) -> DataFrame:
    """Range of the second collection's growth over the reported count, by reported size."""
    api = F.col("api")
    band = F.when(api.isNull(), F.lit(None).cast("string"))
    for name, low, high in BANDS:
        inside = api >= low if high is None else api.between(low, high)
        band = band.when(inside, name)
    return (
        overlap.withColumn("band", band)
        .groupBy("band")
        .agg(
            F.count(F.lit(1)).alias("n_tests"),
            F.min("b_over_api_pct").alias("min_pct"),
            F.max("b_over_api_pct").alias("max_pct"),
        )
    )


def visible_narrow_only(hits: DataFrame) -> DataFrame:
    """URLs a narrow range returned but a wider range around it did not.

    hits: query (its size range is ignored), url, size_min, size_max. The ranges of a query
    are few next to its hits; nesting is found on them, by the range join, and hits only
    meet the ranges around their own.
    """
    seen = hits.select(base_query(F.col("query")).alias("query"), "url", "size_min", "size_max")
    narrow = seen.select("query", "size_min", "size_max").distinct()
    wide = narrow.select(
        "query", F.col("size_min").alias("wide_min"), F.col("size_max").alias("wide_max")
    )
    around = join_in_range(narrow, wide, ["query"], "size_min", "wide_min", "wide_max").filter(
        (F.col("size_max") <= F.col("wide_max"))
        & ((F.col("size_min") > F.col("wide_min")) | (F.col("size_max") < F.col("wide_max")))
    )
    expected = seen.distinct().join(around, ["query", "size_min", "size_max"])
    in_wide = seen.select(
        "query", "url", F.col("size_min").alias("wide_min"), F.col("size_max").alias("wide_max")
    )
    return expected.join(in_wide, ["query", "url", "wide_min", "wide_max"], "left_anti").select(
        "query", "url", "size_min", "size_max", "wide_min", "wide_max"
    )
