import pytest

from gleanery.operators import audit, state
from gleanery.operators.ordering import first_n, with_position
from gleanery.sources.state_store import StateStore

FILES = "seq long, url string, sha string"


def files(spark, n, start=0):
    rows = [(i, f"https://github.com/owner/repo{i}/blob/main/file.md", f"sha{i:04d}") for i in range(start, start + n)]
    return spark.createDataFrame(rows, FILES)


def test_second_delivery_adds_only_new(spark):
    known = files(spark, 3)
    assert state.new_files(known, files(spark, 5)).count() == 2
    assert state.insert_files(known, files(spark, 5)).count() == 5


def test_first_of_a_batch_wins(spark):
    twice = spark.createDataFrame([(2, "u", "late"), (1, "u", "early")], FILES)
    assert [r.sha for r in state.new_files(files(spark, 0), twice).collect()] == ["early"]


def test_upsert_replaces_whole_row(spark):
    current = spark.createDataFrame([("a", "error", 1), ("b", "fetched", 2)], "url string, status string, extra int")
    updates = spark.createDataFrame([(1, "a", "error"), (2, "a", "fetched"), (3, "c", "not_found")], "seq long, url string, status string")
    got = {r.url: (r.status, r.extra) for r in state.upsert(current, updates, "url").collect()}
    assert got == {"a": ("fetched", None), "b": ("fetched", 2), "c": ("not_found", None)}


def test_progress_goes_back_to_open(spark):
    empty = state.empty_state(spark)["scan_progress"]
    updates = "seq long, query string, last_lo long, max_size long, collected long, completed boolean"
    done = state.upsert_progress(empty, spark.createDataFrame([(1, "q", 5, 10, 1, True)], updates), "2024-01-01")
    assert done.first().completed_at is not None
    again = state.upsert_progress(done, spark.createDataFrame([(1, "q", 0, 10, 1, False)], updates), "2024-01-02")
    assert again.first().completed_at is None and again.count() == 1


def test_missing_work(spark):
    known = files(spark, 4)
    status = spark.createDataFrame([(known.first().url, "error")], "url string, status string")
    assert state.files_without_content(known, status).count() == 3
    history = spark.createDataFrame([(known.first().url, [])], "url string, commits array<string>")
    assert state.files_without_history(known, history).count() == 3


@pytest.mark.parametrize(
    "left, right, want",
    [
        (["a", "b"], ["a"], ["b"]),
        (["a", "b"], ["a", None], []),
        (["a", None], ["a"], []),
        (["a", None], ["b"], ["a"]),
        (["a", None], [], ["a", None]),
    ],
)
def test_not_in_null_rules(spark, left, right, want):
    rows = spark.createDataFrame([(x,) for x in left], "k string")
    others = spark.createDataFrame([(x,) for x in right], "k string")
    got = [r.k for r in state.not_in(rows, others, "k").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_unique_repos(spark):
    rows = [
        (1, "https://github.com/o/r/blob/main/a", ""),
        (2, "https://github.com/o/r/blob/main/b", ""),
        (3, "https://github.com/p/q/blob/main/b", ""),
        (4, "https://gitlab.com/p/z/blob/main/b", ""),
    ]
    got = {r.repo_key: r.seq for r in state.unique_repos(spark.createDataFrame(rows, FILES)).collect()}
    assert got == {"o/r": 1, "p/q": 3}


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_positions_are_global_and_sparse_orders_work(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        orders = [0, 3, 2**20 - 1, 2**20, 2**20 + 7, 2**41, 2**41 + 1, 2**59, 2**59 + 2**21]
        df = spark.createDataFrame([(o,) for o in reversed(orders)], "seq long")
        got = {r.seq: r.p for r in with_position(df, "seq", "p").collect()}
        assert got == {o: i for i, o in enumerate(orders)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_position_rejects_orders_out_of_range(spark):
    with pytest.raises(Exception, match="order column out of range"):
        with_position(spark.createDataFrame([(-1,), (2,)], "seq long"), "seq").collect()


def test_hot_key_is_cut_before_the_shuffle(spark, plan_of):
    df = spark.range(1000).selectExpr("concat('k', id % 2) AS k", "id AS seq")
    kept = first_n(df, "k", "seq", 5)
    plan = plan_of(kept, "simple")
    assert plan.count("WindowGroupLimit") == 2
    assert [r.seq for r in kept.orderBy("seq").collect()] == list(range(10))


def test_store_snapshots(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    store.create()
    store.create()
    assert store.read("files").count() == 0
    store.append("files", files(spark, 3))
    store.create()
    assert store.read("files").count() == 3
    hits = spark.createDataFrame([("u", "q", 0, 100)], "url string, query string, size_min long, size_max long")
    store.append("search_hits", hits)
    store.append("search_hits", hits)
    assert store.read("search_hits").count() == 2
    # A snapshot may be built from the one it replaces.
    store.replace("files", store.read("files").limit(2))
    assert store.read("files").count() == 2


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    store.create()
    store.append("files", files(spark, 3))
    torn = tmp_path / "state" / "files" / "snapshot=00000009-torn"
    torn.mkdir()
    assert store.read("files").count() == 3
    store.replace("files", files(spark, 1))
    assert store.read("files").count() == 1


def test_scan_and_sample_keep_order(spark):
    df = files(spark, 20)
    assert [r.seq for r in state.scan_files(df).collect()] == list(range(20))
    assert [r.seq for r in audit.sample_urls(df).collect()] == list(range(10))
    assert state.file_count(df).first().n_files == 20
