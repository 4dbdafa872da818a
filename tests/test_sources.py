import json
import os

import pytest
from pyspark.sql import functions as F

from gleanery.operators import responses, state
from gleanery.sources import content_tree, landed
from gleanery.sources.state_store import StateStore
from gleanery.streaming.ingest import ingest_pages, ingested_files, take_in


def test_flat_cache_skips_what_is_not_json(spark, tmp_path):
    (tmp_path / "aaaa.json").write_text('{"content": "x"}')
    (tmp_path / "bbbb.json").write_text('{"error": "not_found"}')
    (tmp_path / "cccc.json").write_text("not json {")
    (tmp_path / "dddd.json").write_text("")
    (tmp_path / "eeee.json").write_bytes(bytes([0, 1, 2, 255, 254]))
    (tmp_path / "notes.txt").write_text("{}")
    got = {r.key: r.error for r in landed.read_flat_cache(spark, str(tmp_path)).collect()}
    assert got == {"aaaa": None, "bbbb": "not_found"}


def test_search_pages(spark, tmp_path):
    item = {"sha": "s", "name": "n", "path": "p", "html_url": "u", "repository": {"full_name": "o/r"}}
    pages = [
        {"query": "q", "per_page": 100, "page": 1, "attempt": 1, "total_count": 2, "items": [item, {**item, "html_url": "v"}]},
        {"query": "q", "per_page": 100, "page": 2, "attempt": 1, "total_count": 2, "items": []},
    ]
    (tmp_path / "a.json").write_text("\n".join([*(json.dumps(p) for p in pages), '{"query": "cut off']))
    got = responses.search_items(landed.read_search_pages(spark, str(tmp_path))).orderBy("page", "item_no").collect()
    assert [(r.page, r.item_no, r.url, r.full_name) for r in got] == [(1, 0, "u", "o/r"), (1, 1, "v", "o/r"), (2, None, None, None)]


CONTENT = "url string, owner string, repo string, ref string, path string, text string"


def test_tree_round_trip_keeps_hidden_names(spark, tmp_path):
    base = str(tmp_path / "tree")
    rows = [("u1", "o", "r", "main", "a/b.md", "text é\r\n"), ("u2", "o", "r", "main", ".hidden/_x.md", ""), ("u3", "o", "r", "main", "with space+%41.md", "t")]
    content = spark.createDataFrame(rows, CONTENT)
    assert {r.status for r in content_tree.export_tree(content, base).collect()} == {"fetched"}
    assert {r.rel_path for r in content_tree.list_tree(spark, base).collect()} == {
        "o/r/blob/main/a/b.md", "o/r/blob/main/.hidden/_x.md", "o/r/blob/main/with space+%41.md",
    }
    with open(os.path.join(base, "o/r/blob/main/a/b.md"), newline="", encoding="utf-8") as f:
        assert f.read() == "text é\r\n"
    split = content_tree.split_on_disk(content.drop("text"), content_tree.list_tree(spark, base))
    assert split.filter("on_disk").count() == 3


def test_failed_write_is_an_error(spark, tmp_path):
    base = tmp_path / "tree"
    base.mkdir()
    (base / "o").write_text("a file where a folder should be")
    rows = [("u1", "o", "r", "main", "a.md", "t"), ("u2", "p", "r", "main", "a.md", "t")]
    got = {r.url: r.status for r in content_tree.export_tree(spark.createDataFrame(rows, CONTENT), str(base)).collect()}
    assert got == {"u1": "error", "u2": "fetched"}


def test_missing_tree_is_empty(spark, tmp_path):
    assert content_tree.list_tree(spark, str(tmp_path / "none")).count() == 0


def test_content_table_run_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "content")
    content = spark.createDataFrame([("u", "o", "r", "m", "p", "t")], CONTENT).withColumn("status", F.lit("fetched"))
    for run in ("first", "second"):
        content_tree.write_content_table(content, path, run)
    with pytest.raises(ValueError):
        content_tree.write_content_table(content, path, "first")
    os.remove(os.path.join(path, "run=first", "stage=batch", "_SUCCESS"))  # as a killed run leaves it
    content_tree.write_content_table(content, path, "first")
    assert spark.read.parquet(path).groupBy("run").count().filter("count = 1").count() == 2


def test_json_export_keeps_nulls(spark):
    df = spark.createDataFrame([("o/r", ["ai"], None)], "repo_key string, topics array<string>, license string")
    assert content_tree.json_lines(df).first().value == '{"repo_key":"o/r","topics":["ai"],"license":null}'


def land(folder, name, urls, query="q"):
    items = [{"sha": f"sha-{name}", "name": "n", "path": "p", "html_url": u, "repository": {"full_name": "o/r"}} for u in urls]
    page = {"query": query, "per_page": 100, "page": 1, "attempt": 1, "total_count": len(urls), "items": items}
    with open(os.path.join(folder, name + ".json"), "w") as f:
        f.write(json.dumps(page))


def test_ingest_resumes_and_ignores_redelivery(spark, tmp_path):
    inbox, target, offsets = (str(tmp_path / n) for n in ("inbox", "state", "offsets"))
    os.mkdir(inbox)

    def run():
        ingest_pages(spark, inbox, target, offsets, max_files=1).awaitTermination()
        return {r.url: r.sha for r in ingested_files(spark, target).collect()}

    land(inbox, "one", ["a", "b", "a"])
    assert run() == {"a": "sha-one", "b": "sha-one"}
    land(inbox, "two", ["b", "c"])
    land(inbox, "three", ["a", "b", "c", "d"])
    got = run()
    assert set(got) == set("abcd") and got["a"] == got["b"] == "sha-one"
    assert run() == got
    ids = [r.seq for r in ingested_files(spark, target).collect()]
    assert len(ids) == len(set(ids)) == 4
    assert sorted(ids) == [0, 1, 2, 3]
    hits = StateStore(spark, target).read("search_hits")
    assert hits.count() == 9 and hits.filter("size_min IS NULL").count() == 9


def test_ingest_keeps_pages_with_an_odd_item_and_repeats_batches(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    store.create()
    inbox = str(tmp_path / "inbox")
    os.mkdir(inbox)
    land(inbox, "good", ["a", "b"], query="q size:10..19")
    with open(os.path.join(inbox, "good.json")) as f:
        odd = json.load(f)
    odd["items"][0]["repository"] = 7
    odd["items"][0]["html_url"], odd["items"][1]["html_url"] = "c", "d"
    with open(os.path.join(inbox, "odd.json"), "w") as f:
        f.write(json.dumps(odd) + "\n{broken")
    pages = landed._landed_pages(spark, inbox)
    for _ in range(2):  # the batch number is far beyond what a folder number could carry
        take_in(store, pages, "stream", 1 << 40)
    assert {r.url for r in store.read("files").collect()} >= {"a", "b", "d"}
    hits = store.read("search_hits")
    assert {(r.size_min, r.size_max) for r in hits.collect()} == {(10, 19)}
    assert hits.groupBy("url").count().filter("count > 1").isEmpty()
    assert store.read("rejected_pages").count() == landed.rejected_pages(spark, inbox).count() == 2
    take_in(store, pages, "other", 0)
    assert store.read("files").count() == 2 + (hits.count() - 2)


def test_batch_and_stream_agree(spark, tmp_path):
    inbox, target, offsets = (str(tmp_path / n) for n in ("inbox", "state", "offsets"))
    os.mkdir(inbox)
    for i in range(5):
        land(inbox, f"p{i}", [f"u{j}" for j in range(i, i + 4)], query=f"q{i}")
    ingest_pages(spark, inbox, target, offsets).awaitTermination()
    items = responses.search_items(landed.read_search_pages(spark, inbox)).selectExpr("page AS seq", "url", "sha")
    batch = state.new_files(spark.createDataFrame([], "seq int, url string, sha string"), items)
    assert {r.url for r in batch.collect()} == {r.url for r in ingested_files(spark, target).collect()}
