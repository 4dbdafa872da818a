import random

import pytest
from pyspark.sql import functions as F

from gleanery.operators import scan
from gleanery.operators.ranges import assign_ranges, join_in_range
from gleanery.operators.scan import ScanLimits

ITEMS = "query string, size_bytes long"


def plan_rows(spark, est, actual=None, start=0, **limits):
    """Plan for one query from {size: count} tables of claims and true counts."""
    items = [("q", size) for size, n in (actual or est).items() for _ in range(n)]
    claims = spark.createDataFrame([("q", s, n) for s, n in est.items()], "query string, size long, est long")
    scans = spark.createDataFrame([("q", start)], "query string, start_lo long")
    plan = scan.scan_plan(spark.createDataFrame(items, ITEMS), claims, scans, ScanLimits(**limits))
    return [(r.lo, r.hi, r.action) for r in plan.orderBy("step").collect()]


def test_small_range_is_collected_then_the_scan_goes_on(spark):
    got = plan_rows(spark, {50: 50})
    assert got[0] == (0, 9999, "collect") and got[1][0] == 10000


def test_dense_range_is_halved(spark):
    got = plan_rows(spark, {100: 500, 6000: 1500})
    assert got[:2] == [(0, 9999, "narrow"), (0, 4999, "collect")]


def test_full_result_narrows_to_the_exact_size(spark):
    got = plan_rows(spark, {0: 250, 1: 250}, {0: 600, 1: 600}, first_chunk=2)
    assert got[:2] == [(0, 1, "overflow"), (0, 0, "collect")]


def test_exact_size_over_the_cap_is_accepted(spark):
    got = plan_rows(spark, {0: 500}, {0: 1000}, first_chunk=1)
    assert got[0] == (0, 0, "collect") and got[1][0] == 1


def test_no_range_is_asked_twice(spark):
    got = plan_rows(spark, {0: 242, 1: 388}, {0: 242, 1: 758}, first_chunk=2)
    ranges = [(lo, hi) for lo, hi, _ in got]
    assert ranges[:3] == [(0, 1), (0, 0), (1, 2)]
    assert len(ranges) == len(set(ranges))


def test_chunk_doubles_after_collecting(spark):
    got = plan_rows(spark, {0: 50, 7: 50}, first_chunk=5)
    assert got[:2] == [(0, 4, "collect"), (5, 14, "collect")]


def test_ten_empty_ranges_stop_the_scan(spark):
    got = plan_rows(spark, {900_000: 1}, first_chunk=1)
    assert len(got) == 10 and got[-1] == (511, 1022, "stop")


def test_resume_starts_at_the_saved_size(spark):
    got = plan_rows(spark, {10: 5, 500_010: 5}, start=500_000)
    assert got[0] == (500_000, 509_999, "collect")


def test_scan_past_the_axis_has_no_steps(spark):
    assert plan_rows(spark, {10: 5}, start=1_000_001) == []


def test_query_without_items_is_walked(spark):
    scans = spark.createDataFrame([("none", 0)], "query string, start_lo long")
    plan = scan.scan_plan(spark.createDataFrame([], ITEMS), None, scans, ScanLimits(first_chunk=1))
    assert plan.count() == 10


@pytest.mark.parametrize("count", [1000, 1001, 1502])
def test_exact_size_stores_the_first_thousand(spark, count):
    items = spark.range(count).select(
        F.col("id").alias("seq"), F.lit("q").alias("query"), F.concat(F.lit("u"), F.col("id")).alias("url"),
        F.lit("s").alias("sha"), F.lit(0).cast("bigint").alias("size_bytes"),
    )
    plan = scan.scan_plan(items)
    fetched = scan.fetched_items(plan, items)
    kept = scan.scan_collected(fetched)
    assert kept.count() == 1000 and kept.agg(F.max("seq")).first()[0] == 999
    assert plan.filter("lo = 1").count() >= 1


def test_hits_hold_overflowed_requests_too(spark):
    items = spark.createDataFrame(
        [(i, "q", f"u{i}", "s", i // 3) for i in range(12)], "seq long, query string, url string, sha string, size_bytes long"
    )
    claims = spark.createDataFrame([("q", s, 1) for s in range(4)], "query string, size long, est long")
    limits = ScanLimits(cap=4, first_chunk=3)
    plan = scan.scan_plan(items, claims, limits=limits)
    actions = [(r.lo, r.hi, r.action) for r in plan.orderBy("step").collect()]
    assert actions[:3] == [(0, 2, "overflow"), (0, 0, "collect"), (1, 2, "overflow")]
    fetched = scan.fetched_items(plan, items, limits)
    hits = scan.scan_hits(fetched)
    assert hits.filter("size_max = 2 AND size_min = 0").orderBy("url").select("query", "url").collect()[0] == ("q size:0..2", "u0")
    assert hits.filter("size_max = 2 AND size_min = 0").count() == 4
    assert scan.scan_collected(fetched).count() == 12


def test_progress_of_stopped_and_full_scans(spark):
    plan = spark.createDataFrame(
        [("a", 0, 0, 9, "empty"), ("a", 1, 10, 29, "stop"), ("b", 0, 0, 1_000_000, "collect")],
        "query string, step long, lo long, hi long, action string",
    )
    got = {r.query: r.last_lo for r in scan.scan_progress_rows(plan).collect()}
    assert got == {"a": 10, "b": 1_000_001}


def test_open_scans(spark):
    queries = spark.createDataFrame([("new",), ("begun",), ("done",)], "query string")
    progress = spark.createDataFrame(
        [("begun", 500, None), ("done", 9, "2024-01-01")], "query string, last_lo long, completed_at string"
    )
    got = {r.query: r.start_lo for r in scan.open_scans(queries, progress).collect()}
    assert got == {"new": 0, "begun": 500}
    again = {r.query: r.start_lo for r in scan.open_scans(queries, progress, rescan=True).collect()}
    assert again == {"new": 0, "begun": 0, "done": 0}


@pytest.mark.parametrize("seed, top", [(1, 300), (2, 70_000), (3, 5_000_000)])
def test_range_join_equals_brute_force(spark, seed, top):
    rng = random.Random(seed)
    values = [(rng.choice("ab"), rng.randrange(top)) for _ in range(200)] + [("a", 0), ("b", top)]
    ranges = []
    for i in range(60):
        lo = rng.randrange(top)
        ranges.append((rng.choice("ab"), i, lo, min(top, lo + rng.choice([0, 1, 15, 16, 17, 300, 70_000, top]))))
    ranges.append(("a", 99, 0, top))
    v = spark.createDataFrame(sorted(set(values)), "k string, v long")
    r = spark.createDataFrame(ranges, "k string, i int, lo long, hi long")
    got = sorted((x.k, x.v, x.i) for x in join_in_range(v, r, ["k"], "v", "lo", "hi").collect())
    want = sorted((k, x, i) for k, x in set(values) for q, i, lo, hi in ranges if q == k and lo <= x <= hi)
    assert got == want
    twice = v.unionByName(v)
    assert assign_ranges(twice, r, ["k"], "v", "lo", "hi").count() == 2 * len(want)


def brute_walk(counts, claims, limits, lo=0):
    """The scan rule over plain dictionaries, for comparison."""
    chunk, empty, out = limits.first_chunk, 0, []
    while lo <= limits.max_size:
        hi = min(lo + chunk - 1, limits.max_size)
        est = sum(n for s, n in claims.items() if lo <= s <= hi)
        got = min(limits.cap, sum(n for s, n in counts.items() if lo <= s <= hi))
        if est == 0:
            empty += 1
            if empty == limits.empty_stop:
                return [*out, (lo, hi, "stop")]
            out.append((lo, hi, "empty"))
            lo, chunk = hi + 1, min(2 * chunk, limits.max_size)
            continue
        empty = 0
        if lo < hi and (est >= limits.cap or got >= limits.cap):
            out.append((lo, hi, "narrow" if est >= limits.cap else "overflow"))
            chunk = max(1, chunk // 2)
        else:
            out.append((lo, hi, "collect"))
            lo, chunk = hi + 1, min(2 * chunk, limits.max_size)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_plan_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    sizes = [int(rng.paretovariate(0.6)) for _ in range(80)]
    counts = {s: rng.randrange(1, 7) for s in sizes if s <= 5000}
    claims = {s: rng.randrange(0, n + 1) for s, n in counts.items()}
    limits = dict(cap=5, first_chunk=rng.choice([1, 7, 50]), max_size=5000)
    assert plan_rows(spark, claims, counts, **limits) == brute_walk(counts, claims, ScanLimits(**limits))


def test_sizes_off_the_axis_are_one_row_of_their_query(spark):
    rows = [("a", 3), ("a", 3), ("a", 10), ("a", 11), ("a", None), ("a", -1), ("b", None), (None, 2)]
    items = spark.createDataFrame(rows, ITEMS)
    got = {(r.query, r.size): (r.n, r.running) for r in scan.size_histogram(items, ScanLimits(max_size=10), off_axis=True).collect()}
    assert got == {("a", 3): (2, 2), ("a", 10): (1, 3), ("a", None): (3, 6), ("b", None): (1, 1), (None, 2): (1, 1)}
    plain = {(r.query, r.size) for r in scan.size_histogram(items, ScanLimits(max_size=10)).collect()}
    assert plain == {("a", 3), ("a", 10), (None, 2)}
    assert scan.size_histogram(spark.createDataFrame([], ITEMS), off_axis=True).collect() == []
