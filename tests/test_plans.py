"""What the physical plans must and must not contain."""

import re
from concurrent.futures import ThreadPoolExecutor

import pytest

from __spark_entry__ import queries
from gleanery.catalog import all_queries
from gleanery.operators import batching, state

SF = "/root/testdata/sf0.001"
# These run jobs or write files while they are put together; their parts are looked at alone.
EAGER = {
    "commit_replay", "envelope_paths", "growth_by_run", "job_content_killed", "job_metadata_repeated", "late_answers", "multi_range_hits_incremental", "path_rounds", "upsert_merge_read",
    "content_sink", "content_tree_scan", "create_state", "export_json", "job_api", "job_collect_paths", "job_content",
    "job_content_rerun", "job_content_single", "job_history", "job_history_second_run", "job_history_single", "job_metadata",
    "job_metadata_second_run", "job_metadata_single", "record_paths", "resolve_symlinks", "resumable_ingest", "scan_collect", "scan_exact_ceiling",
    "scan_hits", "search_pages_scan",
}


@pytest.fixture(scope="module")
def plans(spark):
    """Plans of all other queries, several at a time."""

    def text(name):
        df = queries()[name](spark, SF)
        return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")

    names = sorted(set(queries()) - EAGER)
    with ThreadPoolExecutor(6) as pool:
        return dict(zip(names, pool.map(text, names)))


@pytest.mark.parametrize("name", sorted(set(queries()) - EAGER))
def test_no_cross_join_and_no_single_task_window(plans, name):
    plan = plans[name]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"Window \[.*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)
    if name in all_queries():  # optional queries may choose their style; their own tests say which must not
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize(
    "name, columns",
    [
        ("file_count", set()),
        ("parse_urls", {"doc_id", "lang", "source"}),
        ("pending_by_repo", {"doc_id", "lang", "source", "n_chars", "quality", "toxic"}),
        ("size_histogram", {"source", "n_chars"}),
        ("history_summary", {"doc_id", "lang", "source", "event_id", "ts", "user_id", "event_type"}),
    ],
)
def test_only_needed_columns_are_read(plans, name, columns):
    plan = plans[name]
    read = {c for fields in re.findall(r"ReadSchema: struct<([^>]*)>", plan) for c in re.findall(r"(\w+):", fields)}
    assert read <= columns


def test_size_filter_reaches_the_scan(plans):
    plan = plans["size_histogram"]
    assert "GreaterThanOrEqual(n_chars,0)" in plan and "LessThanOrEqual(n_chars,1000000)" in plan


def test_request_texts_take_one_shuffle_by_batch(spark, plan_of, tmp_path):
    items = "batch_id long, pos int, url string, owner string, repo string, ref string, path string"
    spark.createDataFrame([(0, 0, "u", "o", "r", "m", "p")], items).write.parquet(str(tmp_path / "items"))
    batched = spark.read.parquet(str(tmp_path / "items"))
    aliased = batching.assign_aliases(batched)
    assert plan_of(batching.content_requests(aliased), "simple").count("Exchange") == 1
    assert plan_of(batching.history_requests(aliased), "simple").count("Exchange") == 1


def test_few_updates_do_not_move_the_table(spark, plan_of, tmp_path):
    rows = "url string, status string"
    spark.range(1000).selectExpr("concat('u', id) AS url", "'error' AS status").write.parquet(str(tmp_path / "status"))
    current = spark.read.schema(rows).parquet(str(tmp_path / "status"))
    updates = spark.createDataFrame([(1, "u5", "fetched")], "seq long, url string, status string")
    done = state.upsert(current, updates, "url")
    assert done.count() == 1000
    done.collect()
    final = plan_of(done, "simple").split("Initial Plan")[0]
    assert "BroadcastHashJoin [url" in final and "SortMergeJoin" not in final


def test_not_in_is_a_plain_anti_join(spark, plan_of, tmp_path):
    keys = spark.range(100).selectExpr("concat('k', id) AS k")
    keys.write.parquet(str(tmp_path / "a"))
    table = spark.read.parquet(str(tmp_path / "a"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(state.not_in(table, table.filter("k <> 'k1'"), "k"), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [k" in plan and "LeftAnti" in plan and "Broadcast" not in plan
