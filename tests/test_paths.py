import pytest
from pyspark.sql import functions as F

from gleanery.operators.paths import next_ranges, open_ranges, range_query
from gleanery.plans import jobs
from gleanery.sources.state_store import StateStore

ASOF = "2024-02-01 00:00:00"
PROBED = "query string, lo long, hi long, chunk long, empties long, total_count long, n_items long"
ITEMS = "query string, url string, sha string"


@pytest.mark.parametrize("lo, hi, chunk, empties, total, items, want", [
    (0, 99, 100, 3, None, None, ("pending", 0, 100, 3, False)),
    (0, 99, 100, 3, 0, None, ("empty", 100, 200, 4, False)),
    (0, 99, 100, 9, 0, None, ("empty", 0, 100, 10, True)),
    (0, 99, 100, 3, 1000, 7, ("narrow", 0, 50, 0, False)),
    (0, 99, 100, 3, 900, 1000, ("narrow", 0, 50, 0, False)),
    (0, 1, 2, 0, 5000, None, ("narrow", 0, 1, 0, False)),
    (7, 7, 1, 0, 5000, 1000, ("over_full", 8, 2, 0, False)),
    (7, 7, 1, 0, 5000, 400, ("collected", 8, 2, 0, False)),
    (0, 99, 100, 3, 999, 999, ("collected", 100, 200, 0, False)),
    (0, 99, 100, 3, 5, None, ("pending", 0, 100, 3, False)),
    (0, 99, 100, 3, 5, 5, ("collected", 100, 200, 0, False)),
    (7, 7, 1, 3, 5000, None, ("pending", 7, 1, 3, False)),
    (900_000, 1_000_000, 800_000, 0, 3, 3, ("collected", 1_000_001, 1_000_000, 0, True)),
    (1_000_000, 1_000_000, 1, 0, 0, None, ("empty", 1_000_001, 2, 1, True)),
])
def test_next_range(spark, lo, hi, chunk, empties, total, items, want):
    r = next_ranges(spark.createDataFrame([("q", lo, hi, chunk, empties, total, items)], PROBED)).first()
    assert (r.action, r.next_lo, r.next_chunk, r.next_empties, r.completed) == want


def test_scan_to_the_end_keeps_every_landed_item(spark, tmp_path):
    """Rounds of plan and record, with a size that holds more than the limit; a killed round is repeated."""
    store = StateStore(spark, str(tmp_path / "state"))
    store.create()
    sizes = {f"u{i}": (i * 37) % 400 for i in range(60)} | {f"same{i}": 5 for i in range(30)}
    queries = spark.createDataFrame([("a",), ("b",), ("a",)], "query string")
    rounds, actions = 0, set()
    while True:
        plan = jobs.plan_paths(store, queries, first_chunk=600_000)
        rows = plan.collect()
        if not rows:
            break
        rounds += 1
        assert rounds < 40
        inside = {r.request: [u for u, s in sizes.items() if r.lo <= s <= r.hi and r.query == "a"] for r in rows}
        # the service counts all, lists 1,000 at most; here it lists all, and twice
        probes = [(q, 1000 if q.startswith("a") and rounds < 4 else len(us)) for q, us in inside.items()]
        items = [(q, u, "s") for q, us in inside.items() for u in us * 2] + [(q, None, None) for q in inside]
        moved = jobs.record_paths(store, plan, spark.createDataFrame(probes, "request string, total_count long"),
                                  spark.createDataFrame(items, ITEMS), ASOF)
        actions |= {r.action for r in moved.collect()}
    files = store.read("files").collect()
    assert sorted(r.url for r in files) == sorted(sizes) and sorted(r.seq for r in files) == list(range(len(sizes)))
    assert {"narrow", "collected", "empty"} <= actions
    hits = store.read("search_hits").filter("size_min > size_max or query is null").count()
    assert hits == 0 and {r.completed_at is not None for r in store.read("scan_progress").collect()} == {True}
    assert jobs.plan_paths(store, queries).count() == 0


def test_pending_ranges_stay(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    store.create()
    plan = jobs.plan_paths(store, spark.createDataFrame([("q",)], "query string"))
    none = spark.createDataFrame([], "request string, total_count long")
    moved = jobs.record_paths(store, plan, none, spark.createDataFrame([], ITEMS), ASOF)
    assert moved.first().action == "pending" and jobs.plan_paths(store, spark.createDataFrame([("q",)], "query string")).collect() == plan.collect()
    assert open_ranges(spark.createDataFrame([], "query string"), store.read("scan_ranges")).collect() == []
    assert spark.range(1).select(range_query(F.lit("q x"), F.lit(1), F.lit(9))).first()[0] == "q x size:1..9"


def test_store_appends_cost_what_they_add(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    store.create()
    rows = lambda a, b: spark.createDataFrame([(f"u{i}", i) for i in range(a, b)], "url string, seq long")
    store.replace("files", rows(0, 5))
    store.append("files", rows(5, 6))
    store.append("files", rows(6, 8))
    torn = store.begin()
    torn.append("files", rows(8, 9))  # as a killed job leaves it
    assert store.read("files").count() == 8
    store.compact("files")
    assert store.read("files").count() == 8 and len(store._latest()[1]["tables"]["files"]) == 1


PAGES = "query string, page long, attempt long, total_count long, item_no int, url string, sha string"
COUNTS = "request string, total_count long"


def pages(request, urls, total, page=1, attempt=1):
    """The rows of one landed page; an empty one keeps a row."""
    return [(request, page, attempt, total, i, u, "s") for i, u in enumerate(urls)] or [(request, page, attempt, total, None, None, None)]


@pytest.fixture
def path_stage(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    store.create()

    def record(plan, probes, items):
        moved = jobs.record_paths(store, plan, spark.createDataFrame(probes, COUNTS), spark.createDataFrame(items, PAGES), ASOF)
        return {r.query: r.action for r in moved.collect()}

    return store, record


def test_count_before_its_list_waits_and_nothing_landed_is_lost(spark, path_stage):
    store, record = path_stage
    queries = spark.createDataFrame([("q",)], "query string")
    plan = jobs.plan_paths(store, queries)
    (first,) = plan.collect()
    assert (first.lo, first.hi) == (0, 9_999)
    request, urls = first.request, [f"u{i}" for i in range(250)]
    assert record(plan, [(request, 250)], []) == {"q": "pending"}
    assert record(plan, [(request, 250)], pages(request, urls[:100], 250)) == {"q": "pending"}
    third = pages(request, urls[200:], 250, 3)
    # the third page before the second, and the first once more
    assert record(plan, [], third + pages(request, urls[:100], 250)) == {"q": "pending"}
    assert store.read("files").count() == 150 and store.read("search_hits").count() == 150
    assert record(plan, [(request, 250)], pages(request, urls[100:200], 250, 2)) == {"q": "collected"}
    (following,) = jobs.plan_paths(store, queries).collect()
    assert (following.lo, following.hi) == (10_000, 29_999)
    # a page of the earlier range that lands now, and the whole delivery again
    late = pages(request, ["late", "u1"], 252, 4)
    for _ in range(2):
        assert record(jobs.plan_paths(store, queries), [], late + third) == {"q": "pending"}
    assert sorted(r.url for r in store.read("files").collect()) == sorted([*urls, "late"])
    hits = store.read("search_hits").collect()
    assert len(hits) == 252 and {(h.size_min, h.size_max) for h in hits} == {(0, 9_999)}
    assert sorted(r.seq for r in store.read("files").collect()) == list(range(251))


@pytest.mark.parametrize("tries, empty_after, want", [
    ([(1, 100), (2, 0)], 250, "pending"),
    ([(1, 100), (2, 0), (2, 0)], 250, "pending"),
    ([(1, 100), (2, 0), (2, 0), (2, 0)], 250, "collected"),
    ([(1, 100), (2, 0)], 100, "collected"),
    ([(1, 0), (1, 100)], 100, "collected"),
    ([(1, 0), (1, 0), (1, 0)], 30, "collected"),
])
def test_walk_over_pages_says_when_a_list_is_whole(spark, path_stage, tries, empty_after, want):
    store, record = path_stage
    plan = jobs.plan_paths(store, spark.createDataFrame([("q",)], "query string"))
    request, seen, rows = plan.first().request, {}, []
    for page, n in tries:
        seen[page] = seen.get(page, 0) + 1
        rows += pages(request, [f"u{page}.{i}" for i in range(n)], empty_after, page, seen[page])
    assert record(plan, [(request, empty_after)], rows) == {"q": want}


def test_lonely_large_file_is_found(spark, path_stage):
    store, record = path_stage
    queries = spark.createDataFrame([("q",)], "query string")
    while True:
        plan = jobs.plan_paths(store, queries)
        if plan.isEmpty():
            break
        (r,) = plan.collect()
        there = r.lo <= 500_000 <= r.hi
        record(plan, [(r.request, int(there))], pages(r.request, ["large"] if there else [], int(there)))
    assert [r.url for r in store.read("files").collect()] == ["large"]


def test_rescan_starts_anew_and_takes_its_own_pages(spark, path_stage):
    store, record = path_stage
    queries = spark.createDataFrame([("q",)], "query string")
    plan = jobs.plan_paths(store, queries, first_chunk=1_000_001)
    request = plan.first().request
    assert record(plan, [(request, 1)], pages(request, ["a"], 1)) == {"q": "collected"}
    assert jobs.plan_paths(store, queries).isEmpty()
    again = jobs.plan_paths(store, queries, first_chunk=1_000_001, rescan=True)
    assert again.first().scan == 1 and again.first().request == request
    second = spark.createDataFrame(pages(request, ["a", "b"], 2), PAGES).withColumn("scan", F.lit(1))
    counts = spark.createDataFrame([(request, 2)], COUNTS)
    for _ in range(2):
        jobs.record_paths(store, again, counts, second, ASOF)
    assert {r.url for r in store.read("files").collect()} == {"a", "b"} and store.read("search_hits").count() == 3
    assert jobs.plan_paths(store, queries).isEmpty()


def test_full_ranges_are_cut_into_pieces_asked_for_side_by_side(spark, path_stage):
    """Rounds do not grow with the files; a killed or repeated call opens no piece again, a rescan leaves none behind."""
    store, record = path_stage
    queries = spark.createDataFrame([("a",), ("b",)], "query string")
    sizes = {f"u{i}": i for i in range(8_000)} | {f"same{i}": 77 for i in range(1_200)} | {"far": 900_000}
    rounds, first = 0, None
    while not (plan := jobs.plan_paths(store, queries)).isEmpty():
        rounds += 1
        assert rounds < 12
        inside = {r.request: [u for u, s in sizes.items() if r.lo <= s <= r.hi and r.query == "a"] for r in plan.collect()}
        alone = {r.request for r in plan.collect() if r.lo == r.hi}
        rows = [row for q, us in inside.items() if len(us) < 1000 or q in alone
                for at in range(0, max(len(us), 1), 100) for row in pages(q, us[at:at + 100], len(us), at // 100 + 1)]
        counts = [(q, len(us)) for q, us in inside.items()]
        record(plan, counts, rows)
        if first is None:
            first = plan, counts, rows
            record(*first)
            assert (pieces := jobs.plan_paths(store, queries).filter("is_cut").collect()) and len(pieces) > 15
            assert sorted(s for r in pieces for s in range(r.lo, r.hi + 1)) == list(range(10_000))
    assert sorted(r.url for r in store.read("files").collect()) == sorted(sizes)
    done = store.read("scan_progress")
    assert done.count() == 2 and done.filter("completed_at is null").isEmpty()
    again = jobs.plan_paths(store, queries, rescan=True).withColumn("is_cut", F.lit(False))
    assert record(again, first[1], []) == {"a": "narrow", "b": "empty"}
    assert {r.scan for r in jobs.plan_paths(store, queries).collect()} == {1}
    assert store.read("scan_progress").filter("completed_at is null").count() == 2
