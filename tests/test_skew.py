"""One query, size, URL or repository with a third of all rows."""

import contextlib

import pytest
from pyspark.sql import functions as F

from gleanery.operators import audit, batching, ranges, scan, state
from gleanery.operators.scan import ScanLimits

N = 60_000


@contextlib.contextmanager
def conf(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def items(spark):
    hot = F.col("id") % 3 == 0
    return spark.range(N, numPartitions=8).select(
        F.col("id").alias("seq"),
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("q"), F.col("id") % 50)).alias("query"),
        F.when(hot, F.lit(7)).otherwise(F.col("id") % 90_000).cast("bigint").alias("size_bytes"),
        F.concat(F.lit("https://github.com/"), F.when(hot, F.lit("big/repo")).otherwise(F.concat(F.lit("o/r"), F.col("id") % 999)),
                 F.lit("/blob/main/f"), F.col("id").cast("string")).alias("url"),
        F.lit("s").alias("sha"),
    )


def test_hot_size_is_split_by_the_range_join(spark, items, plan_of):
    """AQE cuts the hot join key into parts; every item still gets its range."""
    widths = spark.createDataFrame([("hot", 0, 9)] + [(f"q{i}", lo, lo + 999) for i in range(50) for lo in range(0, 90_000, 1000)], "query string, lo long, hi long")
    small = {
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
        "spark__sql__shuffle__partitions": "8",
    }
    with conf(spark, **small):
        placed = ranges.assign_ranges(items, widths, ["query"], "size_bytes", "lo", "hi")
        assert len(placed.collect()) == N
        assert "skew=true" in plan_of(placed, "simple")


def test_hot_size_is_cut_before_the_scan_joins_it(spark, items, plan_of):
    limits = ScanLimits(cap=1000, first_chunk=10_000)
    plan = scan.scan_plan(items, limits=limits)
    fetched = scan.fetched_items(plan, items, limits)
    assert plan_of(fetched, "simple").count("WindowGroupLimit") == 2
    per_query = {r.query: r.n for r in scan.scan_collected(fetched).groupBy("query").agg(F.count("*").alias("n")).collect()}
    assert per_query["hot"] == 1000
    assert sum(n for q, n in per_query.items() if q != "hot") == N - N // 3


def test_hot_url_in_deliveries_and_updates(spark, items, plan_of):
    delivered = items.withColumn("url", F.when(F.col("query") == "hot", "u").otherwise(F.col("url")))
    known = spark.createDataFrame([], "seq long, url string, sha string")
    new = state.new_files(known, delivered.select("seq", "url", "sha"))
    assert new.count() == N - N // 3 + 1
    assert plan_of(new, "simple").count("WindowGroupLimit") == 2
    status = spark.createDataFrame([("u", "error")], "url string, status string")
    updates = delivered.select("seq", "url", F.lit("fetched").alias("status"))
    done = state.upsert(status, updates, "url")
    assert done.count() == N - N // 3 + 1 and done.filter("status = 'error'").count() == 0


def test_hot_repository_is_spread_over_batches(spark, items):
    parsed = state.parsed_files(items)
    aliased = batching.assign_aliases(batching.assign_batches(parsed, 50))
    sizes = aliased.groupBy("batch_id").agg(F.count("*").alias("n"), F.max("pos").alias("last"))
    assert sizes.filter("n <> 50 OR last <> 49").count() == 0 and sizes.count() == N // 50
    longest = aliased.groupBy("batch_id", "owner", "repo").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    assert longest <= 50


def test_hot_range_and_hot_url_in_hits(spark, items):
    hits = items.select("query", "url", F.lit(0).alias("size_min"), F.lit(9999).alias("size_max")).unionByName(
        items.filter("query <> 'hot'").select("query", "url", F.lit(0).alias("size_min"), F.lit(99).alias("size_max"))
    )
    repeated = hits.withColumn("url", F.when(F.col("query") == "hot", "u").otherwise(F.col("url")))
    multi = audit.multi_range_hits(repeated)
    assert multi.count() == N - N // 3
    assert audit.visible_narrow_only(repeated).count() == 0
