import json

import pytest
from pyspark.sql import functions as F

from gleanery.functions import keys, text
from gleanery.operators.scan import ScanLimits
from gleanery.plans import jobs
from gleanery.sources.state_store import StateStore

ASOF = "2024-02-01 00:00:00"
CACHE = "key string, body string, error string, cached_at timestamp"
SINGLES = "url string, status int, error string, content string, is_folder boolean"


def url(i, ref="main", repo="r"):
    return f"https://github.com/o/{repo}/blob/{ref}/f{i}.md"


@pytest.fixture
def store(spark, tmp_path):
    new = StateStore(spark, str(tmp_path / "state"))
    new.create()
    return new


def put_files(spark, store, urls):
    rows = [(i, u, f"sha{i}") for i, u in enumerate(urls)]
    store.append("files", spark.createDataFrame(rows, "seq long, url string, sha string"))


def cache_entry(spark, key_column, body, error=None, at="2024-01-20"):
    return (
        spark.range(1)
        .select(key_column.alias("key"), F.lit(body).alias("body"), F.lit(error).cast("string").alias("error"),
                F.lit(at).cast("timestamp").alias("cached_at"))
    )


def landed(spark, plan, bodies):
    """Answers by the key of the request that the batch number stands for."""
    key_of = {r.batch_id: r.request_key for r in plan.requests.collect()}
    return spark.createDataFrame([(key_of[b], body) for b, body in bodies], "request_key string, body string")


def statuses(store):
    return {r.url: r.status for r in store.read("content_status").collect()}


def test_content_run_and_rerun(spark, store, tmp_path):
    urls = [url(i) for i in range(8)] + ["https://gitlab.com/x"]
    put_files(spark, store, urls)
    place = lambda i: [F.lit(v) for v in ("o", "r", "main", f"f{i}.md")]
    body = json.dumps({"content": "Y2FjaGVk"})
    cached = cache_entry(spark, keys.content_key(*place(6)), body).unionByName(
        cache_entry(spark, keys.content_key(*place(7)), None, "not_found", at="2023-01-01")
    )
    tree = spark.createDataFrame([("o/r/blob/main/f5.md",)], "rel_path string")
    plan = jobs.plan_content(store, tree, cached, ASOF, batch_size=4)

    assert [r.url for r in plan.rejected.collect()] == ["https://gitlab.com/x"]
    assert [r.url for r in plan.skipped.collect()] == [url(5)]
    assert [r.url for r in plan.hits.collect()] == [url(6)]
    batches = {r.url: (r.batch_id, r.pos) for r in plan.open_items.collect()}
    assert batches == {url(i): (n // 4, n % 4) for n, i in enumerate([0, 1, 2, 3, 4, 7])}
    assert plan.requests.count() == 2

    def blob(t, cut=False):
        return {"text": t, "byteSize": 9, "isTruncated": cut}

    first = {"data": {"r0": {"f0": blob("zero"), "f1": None, "f2": blob("part", True), "f3": blob("part", True)}}}
    answers = landed(spark, plan, [(0, json.dumps(first)), (1, '{"errors":[]}')])
    singles = spark.createDataFrame([(url(2), 200, None, "d2hvbGU=", False), (url(0), 200, None, "bm8=", False)], SINGLES)
    content = str(tmp_path / "content")
    counters = jobs.record_content(store, plan, answers, singles, content, "one", ASOF).first().asDict()

    assert counters == {"fetched": 2, "skipped": 1, "not_found": 1, "errors": 3, "truncated_rest": 1, "pending": 1, "cache_hits": 1}
    assert sum(counters.values()) - counters["cache_hits"] == len(urls)
    assert statuses(store) == {url(0): "fetched", url(1): "not_found", url(2): "fetched", url(5): "fetched", url(6): "fetched"}
    texts = {r.url: r.text for r in spark.read.parquet(content).filter("status = 'fetched'").collect()}
    assert texts == {url(0): "zero", url(2): "whole", url(6): "cached"}

    again = jobs.plan_content(store, tree, cached, ASOF, batch_size=4)
    assert {r.url for r in again.open_items.collect()} == {url(3), url(4), url(7)}


def test_answers_of_earlier_runs_and_repeats(spark, store, tmp_path):
    """An old answer in the folder, a repeated one and a key cached twice: texts stay with their URLs."""
    put_files(spark, store, [url(i) for i in range(5)])
    nowhere = spark.createDataFrame([], "rel_path string")
    empty = spark.createDataFrame([], CACHE)
    place = [F.lit(v) for v in ("o", "r", "main", "f4.md")]
    cached = [cache_entry(spark, keys.content_key(*place), json.dumps({"content": c}), at=at)
              for c, at in (("bmV3", "2024-01-21"), ("b2xk", "2024-01-20"))]
    twice = cached[0].unionByName(cached[1])
    content = str(tmp_path / "content")
    singles = spark.createDataFrame([], SINGLES)

    def answer(plan, when, *texts):
        key = plan.requests.filter("batch_id = 0").first().request_key
        files = {f"f{i}": {"text": t, "byteSize": 1, "isTruncated": False} for i, t in enumerate(texts)}
        return (key, when, json.dumps({"data": {"r0": files}}))

    def frame(rows):
        return spark.createDataFrame(rows, "request_key string, answered_at string, body string")

    first = jobs.plan_content(store, nowhere, twice, ASOF, batch_size=2)
    old = answer(first, "2024-01-01", "zero", "one")
    again = answer(first, "2024-01-02", "ZERO", "ONE")
    counters = jobs.record_content(store, first, frame([old, again, old]), singles, content, "a", ASOF).first()
    assert (counters.fetched, counters.cache_hits) == (3, 1)
    second = jobs.plan_content(store, nowhere, empty, ASOF, batch_size=2)
    assert {r.url for r in second.open_items.collect()} == {url(2), url(3)}
    both = frame([old, again, answer(second, "2024-01-01", "two", "three")])
    with pytest.raises(ValueError):
        jobs.record_content(store, second, both, singles, content, "a", ASOF)
    jobs.record_content(store, second, both, singles, content, "b", ASOF)
    texts = {r.url: r.text for r in spark.read.parquet(content).collect()}
    assert texts == {url(0): "ZERO", url(1): "ONE", url(2): "two", url(3): "three", url(4): "new"}
    assert spark.read.parquet(content).count() == 5 and len(statuses(store)) == 5


def test_metadata_run(spark, store):
    put_files(spark, store, [url(0), url(1, repo="gone"), url(2, repo="cached"), url(3, repo="empty"), url(4)])
    known = cache_entry(spark, keys.metadata_key(F.lit("o/cached")), json.dumps({"stars": 7, "topics": ["a"]}))
    blank = cache_entry(spark, keys.metadata_key(F.lit("o/empty")), "{}")
    plan = jobs.plan_metadata(store, known.unionByName(blank), ASOF)
    assert [(r.repo_key, r.pos) for r in plan.open_items.orderBy("pos").collect()] == [("o/r", 0), ("o/gone", 1)]
    body = {"data": {"r0": {"stargazerCount": 3}, "r1": None}}
    answers = landed(spark, plan, [(0, json.dumps(body))])
    counters = jobs.record_metadata(store, plan, answers, ASOF).first()
    assert (counters.fetched, counters.errors, counters.cache_hits) == (2, 1, 2)
    rows = {r.repo_key: (r.stars, r.topics) for r in store.read("repo_metadata").collect()}
    assert rows == {"o/r": (3, []), "o/cached": (7, ["a"])}
    left = jobs.plan_metadata(store, spark.createDataFrame([], CACHE), ASOF)
    assert {r.repo_key for r in left.open_items.collect()} == {"o/gone", "o/empty"}


def test_history_run_shares_answers_between_refs(spark, store):
    put_files(spark, store, [url(0), url(0, ref="dev"), url(1), url(2), "https://gitlab.com/x"])
    commits = [{"sha": "abc", "author": None, "date": "d", "message": "m"}]
    key = keys.history_key(F.lit("o"), F.lit("r"), F.lit("f0.md"))
    plan = jobs.plan_history(store, cache_entry(spark, key, json.dumps({"commits": commits})), ASOF)
    assert plan.hits.count() == 2
    body = {"data": {"r0": {"ref0": {"f0": {"nodes": []}, "f1": None}}}}
    answers = landed(spark, plan, [(0, json.dumps(body))])
    counters = jobs.record_history(store, plan, answers, ASOF).first()
    assert (counters.fetched, counters.errors, counters.cache_hits) == (3, 2, 2)
    rows = {r.url: [c.sha for c in r.commits] for r in store.read("file_history").collect()}
    assert rows == {url(0): ["abc"], url(0, ref="dev"): ["abc"], url(1): []}


ITEMS = "seq long, query string, url string, sha string, size_bytes long"


def test_scan_runs_resume_and_rescan(spark, store):
    limits = ScanLimits(cap=3, first_chunk=10, max_size=1000)
    first = spark.createDataFrame([(i, "a", f"u{i}", "s", i * 7) for i in range(9)], ITEMS)
    jobs.collect_paths(store, first, ASOF, limits=limits)
    assert store.read("files").count() == 9
    done = store.read("scan_progress").first()
    assert done.completed_at is not None and done.collected == 9
    n_hits = store.read("search_hits").count()

    more = first.unionByName(spark.createDataFrame([(20, "b", "u3", "other", 5), (21, "b", "new", "s", 6)], ITEMS))
    jobs.collect_paths(store, more, ASOF, limits=limits)
    files = {r.url: (r.sha, r.seq) for r in store.read("files").collect()}
    assert len(files) == 10 and files["u3"][0] == "s" and files["new"] == ("s", 9)
    assert store.read("search_hits").count() == n_hits + 2
    assert {r.query: r.collected for r in store.read("scan_progress").collect()} == {"a": 9, "b": 10}

    jobs.collect_paths(store, more, ASOF, limits=limits, rescan=True)
    assert store.read("files").count() == 10
    assert store.read("search_hits").count() > n_hits + 2


def test_text_of_cached_bodies(spark):
    assert spark.range(1).select(text.decoded_text(F.lit("Y2FjaGVk"))).first()[0] == "cached"
