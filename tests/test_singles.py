import base64
import json

import pytest
from pyspark.sql import functions as F

from gleanery.plans import calls, jobs, singles
from gleanery.sources.state_store import StateStore

ASOF = "2024-02-01 00:00:00"
SINGLES = (
    "owner string, repo string, ref string, path string, status int, error string, content string, "
    "is_folder boolean, is_link boolean, target string"
)


@pytest.fixture
def store(spark, tmp_path):
    new = StateStore(spark, str(tmp_path / "state"))
    new.create()
    return new


def test_single_content_follows_links(spark, store, tmp_path):
    names = ["plain", "empty", "link", "loop", "out", "gone", "folder", "refused", "waiting", "silent"]
    urls = {n: f"https://github.com/o/r/blob/main/d/{n}" for n in names}
    store.append("files", spark.createDataFrame([(i, urls[n], "s") for i, n in enumerate(names)], "seq long, url string, sha string"))

    def answer(path, status=200, content=None, target=None, folder=False):
        encoded = None if content is None else base64.b64encode(content.encode()).decode()
        return ("o", "r", "main", path, status, None, encoded, folder, target is not None, target)

    rows = [
        answer("d/plain", content="text"), answer("d/empty", content=""), answer("d/link", target="../e/one"),
        answer("e/one", target="two"), answer("e/two", content="end"), answer("d/loop", target="loop"),
        answer("d/out", target="/etc/x"), answer("d/gone", 404), answer("d/folder", folder=True),
        answer("d/refused", 500), answer("d/waiting", target="later"),
    ]
    landed = spark.createDataFrame(rows, SINGLES)
    assert [r.path for r in singles.link_requests(landed).collect()] == ["d/later"]
    plan = jobs.plan_content(store, spark.createDataFrame([], "rel_path string"), None, ASOF)
    content = str(tmp_path / "content")
    counters = singles.record_content(store, plan, landed.unionByName(landed), content, "one", ASOF).first().asDict()
    assert counters == {"fetched": 3, "skipped": 0, "not_found": 3, "errors": 2, "truncated_rest": 0, "pending": 2, "cache_hits": 0}
    got = {r.url: r.status for r in store.read("content_status").collect()}
    want = {"plain": "fetched", "empty": "fetched", "link": "fetched", "loop": "error", "out": "not_found", "gone": "not_found",
            "folder": "not_found", "refused": "error"}
    assert got == {urls[n]: s for n, s in want.items()}
    texts = {r.url: r.text for r in spark.read.parquet(content).filter("status = 'fetched'").collect()}
    assert texts == {urls["plain"]: "text", urls["empty"]: "", urls["link"]: "end"}
    kept = {r.error: r["count"] for r in store.read("response_cache").groupBy("error").count().collect()}
    assert kept == {None: 3, "unresolvable_symlink": 1, "not_found": 1}


def test_free_calls(spark, store):
    rows = [(1, "GET", "a"), (2, "GET", "b"), (3, "POST", "a"), (4, "GET", "c"), (5, "GET", "a"), (6, "GET", "late")]
    wanted = spark.createDataFrame(rows, "call_id long, method string, endpoint string").withColumn(
        "params", F.lit(None).cast("map<string,string>")
    )
    answers = {"a": [(500, "oops"), (200, '{"n":1}')], "b": [(404, "no")], "c": [(204, "")]}

    def run():
        plan = calls.plan_calls(store, wanted, ASOF)
        keys = {(r.endpoint, r.method): r.key for r in plan.requests.collect()}
        log = [(key, method, f"2024-01-0{i + 1}", status, body if method == "GET" else '{"n":2}', "tag", None)
               for (endpoint, method), key in keys.items() for i, (status, body) in enumerate(answers.get(endpoint, []))]
        log = spark.createDataFrame(log, "key string, method string, answered_at string, status int, body string, etag string, link string")
        done = calls.record_calls(store, plan, log, ASOF)
        return {r.call_id: (r.is_hit, r.disposition, r.status, r.body) for r in done.collect()}

    one = '{"n":1}'
    first = run()
    assert first == {
        1: (False, "success", 200, one), 2: (False, "terminal", 404, "no"), 3: (False, "success", 200, '{"n":2}'),
        4: (False, "success", 204, "{}"), 5: (False, "success", 200, one), 6: (False, "pending", None, None),
    }
    second = run()
    assert {i for i, r in second.items() if r[0]} == {1, 4, 5}
    assert second[1] == (True, "success", 200, one) and second[3] == first[3] and second[6] == first[6]


def test_batched_calls_keep_answers_with_data(spark, store):
    wanted = spark.createDataFrame([(1, "{a}", None), (2, "{b}", '{"x": 1}')], "call_id long, request string, variables string")
    plan = calls.plan_batches(store, wanted, ASOF)
    bodies = {1: '{"data":{"a":1}}', 2: '{"errors":[]}'}
    log = spark.createDataFrame(
        [(r.key, r.method, "t", 200, bodies[r.call_id], None, None) for r in plan.requests.collect()],
        "key string, method string, answered_at string, status int, body string, etag string, link string",
    )
    calls.record_calls(store, plan, log, ASOF)
    again = calls.plan_batches(store, wanted, ASOF)
    assert [r.call_id for r in again.hits.collect()] == [1] and [r.call_id for r in again.requests.collect()] == [2]
    assert json.loads(again.hits.first().body)["status"] == 200
