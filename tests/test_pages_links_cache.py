import random

import pytest
from pyspark.sql import functions as F

from gleanery.operators import cache, links, responses

ITEMS = "query string, page int, attempt int, total_count long, url string"


def page(no, attempt, total, n):
    if n == 0:
        return [("q", no, attempt, total, None)]
    return [("q", no, attempt, total, f"u{no}-{attempt}-{i}") for i in range(n)]


@pytest.mark.parametrize(
    "attempts, want",
    [
        ([(1, 1, 300, 100), (2, 1, 300, 100), (3, 1, 300, 100), (4, 1, 300, 0)], 300),
        ([(1, 1, 50, 50), (2, 1, 50, 0)], 50),
        ([(1, 1, 200, 100), (2, 1, 200, 0), (2, 2, 200, 0), (2, 3, 200, 0)], 100),
        ([(1, 1, 200, 100), (2, 1, 200, 0), (2, 2, 200, 100)], 200),
        ([(1, 1, 1, 1), (2, 1, 1, 0)], 1),
        ([(1, 1, 0, 0)], 0),
        ([(p, 1, 5000, 100) for p in range(1, 13)], 1000),
        ([(1, 1, 300, 100), (3, 1, 300, 100)], 100),
    ],
)
def test_pages_of_one_search(spark, attempts, want):
    rows = [row for a in attempts for row in page(*a)]
    got = responses.assemble_pages(spark.createDataFrame(rows, ITEMS))
    assert got.filter("in_walk").count() == want
    assert got.count() == sum(a[3] for a in attempts)


def loop_result(log, total_of_first):
    """Page by page over a log of attempt sizes, as plain steps."""
    kept, have, no, empties = [], 0, 1, 0
    while no <= 10:
        sizes = log.get(no, [])
        n = sizes[empties] if empties < len(sizes) else 0
        if n:
            kept.append((no, empties + 1))
            have, no, empties = have + n, no + 1, 0
            continue
        if have >= min(total_of_first, no * 100) or have >= total_of_first:
            break
        empties += 1
        if empties == 3:
            break
    return kept


def test_pages_equal_the_loop_on_random_logs(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for q in range(150):
        total = rng.choice([0, 1, 90, 100, 250, 1000, 4000])
        log = {p: [rng.choice([0, 0, rng.randrange(1, 101), 100]) for _ in range(rng.randrange(1, 5))] for p in range(1, 13)}
        for p, sizes in log.items():
            for a, n in enumerate(sizes, 1):
                rows.append((f"q{q}", p, a, n, total))
        want[f"q{q}"] = loop_result(log, total)
    attempts = spark.createDataFrame(rows, "query string, page int, attempt int, n_items long, total_count long")
    got = {}
    for r in responses.usable_pages(attempts).orderBy("query", "page").collect():
        got.setdefault(r.query, []).append((r.page, r.attempt))
    assert got == {q: k for q, k in want.items() if k}


def test_links(spark):
    rows = [("r", "file", None), ("r", "abs", "/etc/x"), ("r", "empty", ""), ("r", "dead", "nowhere"), ("r", "self", "self"),
            ("r", "a/one", "../a/two"), ("r", "a/two", "three"), ("r", "a/three", "../file"), ("r", "toabs", "abs"),
            ("s", "x", "file")]
    rows += [("r", f"c{i}", f"c{i + 1}") for i in range(1000)] + [("r", "c1000", "file")]
    got = {(r.repo_key, r.path): (r.final_path, r.status) for r in links.resolve_links(spark.createDataFrame(rows, "repo_key string, path string, target string")).collect()}
    assert len(got) == len(rows)
    assert got[("r", "file")] == ("file", "resolved")
    assert got[("r", "abs")] == got[("r", "empty")] == got[("r", "toabs")] == (None, "unresolvable_symlink")
    assert got[("r", "dead")] == got[("s", "x")] == (None, "not_found")
    assert got[("r", "self")] == (None, "too_deep")
    assert got[("r", "a/one")] == got[("r", "a/three")] == ("file", "resolved")
    assert got[("r", "c0")] == ("file", "resolved")


CACHE = "key string, body string, error string, cached_at timestamp"
ASOF = "2024-02-01 00:00:00"


def cached(spark):
    rows = [("a", "1", None, "2024-01-20"), ("b", "2", "not_found", "2024-01-20"), ("c", "3", None, "2024-01-02 00:00:00"), ("d", "4", None, "2024-01-02 00:00:01")]
    return spark.createDataFrame(rows, "key string, body string, error string, at string").withColumn("cached_at", F.col("at").cast("timestamp")).drop("at")


@pytest.mark.parametrize(
    "flags, found", [({}, "abd"), ({"skip_read": True}, ""), ({"retry_errors": True}, "ad")]
)
def test_cache_lookup(spark, flags, found):
    asked = spark.createDataFrame([(k,) for k in "abcde"], "key string")
    got = cache.lookup(asked, cached(spark), ASOF, **flags)
    assert "".join(sorted(r.key for r in got.filter("is_hit").collect())) == found
    entries = cache.readable_entries(cached(spark), ASOF, **flags)
    assert "".join(sorted(r.key for r in cache.hits(asked, entries).collect())) == found
    assert cache.misses(asked, entries).count() == 5 - len(found)


def test_cache_write_replaces(spark):
    entries = spark.createDataFrame([(1, "a", "new"), (2, "e", "x")], "seq long, key string, body string")
    got = {r.key: (r.body, r.error) for r in cache.write_entries(cached(spark), entries).collect()}
    assert got["a"] == ("new", None) and got["e"] == ("x", None) and len(got) == 5


def test_admission(spark):
    df = spark.createDataFrame(
        [("GET", 200, True), ("GET", 204, True), ("POST", 201, False), ("GET", 404, False), ("GET", 502, False), ("GET", None, False)],
        "m string, s int, want boolean",
    )
    assert all(r.want == r.got for r in df.select("want", cache.admit_call(F.col("m"), F.col("s")).alias("got")).collect())
    pages = spark.createDataFrame([(200, 0, 1, True), (200, 0, 2, False), (200, 3, 2, True), (422, 0, 1, False)], "s int, n int, p int, want boolean")
    assert all(r.want == r.got for r in pages.select("want", cache.admit_search(F.col("s"), F.col("n"), F.col("p")).alias("got")).collect())
    errors = spark.createDataFrame([(None, True), ("not_found", True), ("no_content", True), ("unresolvable_symlink", True), ("truncated", False), ("directory", False)], "e string, want boolean")
    assert all(r.want == r.got for r in errors.select("want", cache.admit_content(F.col("e")).alias("got")).collect())
