import json

from pyspark.sql import functions as F

from gleanery.functions import text
from gleanery.operators import batching, responses

ITEMS = "batch_id long, pos int, url string, owner string, repo string, ref string, path string"


def aliased(spark, items):
    rows = [(0, i, f"u{i}", *item) for i, item in enumerate(items)]
    return batching.assign_aliases(spark.createDataFrame(rows, ITEMS))


MIXED = [
    ("o", "a", "main", "x.md"),
    ("o", "b", "main", "y.md"),
    ("o", "a", "dev", "z.md"),
    ("o", "a", "main", 'w"\\.md'),
]


def test_aliases_follow_first_appearance(spark):
    got = {r.pos: (r.repo_no, r.ref_no, r.file_no) for r in aliased(spark, MIXED).collect()}
    assert got == {0: (0, 0, 0), 1: (1, 0, 0), 2: (0, 1, 0), 3: (0, 0, 1)}


def test_content_request_text(spark):
    request = batching.content_requests(aliased(spark, MIXED)).first().request
    assert request == "\n".join(
        [
            "query {",
            '  r0: repository(owner: "o", name: "a") {',
            '    f0: object(expression: "main:x.md") {',
            "      ... on Blob { text byteSize isTruncated }",
            "    }",
            '    f2: object(expression: "dev:z.md") {',
            "      ... on Blob { text byteSize isTruncated }",
            "    }",
            '    f3: object(expression: "main:w\\"\\\\.md") {',
            "      ... on Blob { text byteSize isTruncated }",
            "    }",
            "  }",
            '  r1: repository(owner: "o", name: "b") {',
            '    f1: object(expression: "main:y.md") {',
            "      ... on Blob { text byteSize isTruncated }",
            "    }",
            "  }",
            "}",
        ]
    )


def test_history_request_text(spark):
    request = batching.history_requests(aliased(spark, MIXED[:3])).first().request
    assert '    ref1: object(expression: "dev") {\n      ... on Commit {\n        f0: history(first: 100, path: "z.md") {' in request
    assert request.count("repository(") == 2 and request.count("history(first: 100") == 3


def test_metadata_request_splits_at_first_slash(spark):
    rows = spark.createDataFrame([(0, 0, "o/r"), (0, 1, "p/")], "batch_id long, pos int, repo_key string")
    request = batching.metadata_requests(rows).first().request
    assert 'r0: repository(owner: "o", name: "r") {\n    stargazerCount\n' in request
    assert 'r1: repository(owner: "p", name: "") {' in request


def test_batches_are_consecutive(spark):
    df = spark.range(0, 120 * 7, 7).withColumnRenamed("id", "seq")
    got = batching.assign_batches(df, 50).orderBy("seq").collect()
    assert [(r.batch_id, r.pos) for r in got] == [(i // 50, i % 50) for i in range(120)]


def test_content_answers_and_errors(spark):
    items = aliased(spark, [("o", "a", "m", f"{i}") for i in range(5)] + [("o", "gone", "m", "x")])
    body = {
        "data": {
            "r0": {
                "f0": {"text": "hello", "byteSize": 5, "isTruncated": False},
                "f1": None,
                "f2": {"text": None, "byteSize": 9, "isTruncated": False},
                "f3": {"text": "part", "byteSize": 200000, "isTruncated": True},
                "f4": {"text": "", "byteSize": 0, "isTruncated": False},
            },
            "r1": None,
        }
    }
    answers = spark.createDataFrame([(0, json.dumps(body))], "batch_id long, body string")
    got = responses.content_answers(items, answers).withColumn("error", responses.content_error())
    rows = {r.pos: r for r in got.select("*", responses.batched_outcome(F.col("error"), F.col("text")).alias("o")).collect()}
    assert [rows[i].error for i in range(6)] == [None, "not_found", "no_content", "truncated", None, "not_found"]
    assert [rows[i].o for i in range(6)] == ["fetched", "not_found", "error", "truncated", "error", "not_found"]
    assert rows[0].text == "hello" and rows[3].byte_size == 200000


def test_answer_without_data_is_an_error_for_all(spark):
    items = aliased(spark, MIXED)
    failed = spark.createDataFrame([(0, '{"errors":[{"type":"RATE_LIMITED"}]}')], "batch_id long, body string")
    got = responses.content_answers(items, failed).select(responses.content_error().alias("e")).collect()
    assert [r.e for r in got] == ["error"] * 4


def test_unanswered_batches_stay_out(spark):
    none = spark.createDataFrame([], "batch_id long, body string")
    assert responses.content_answers(aliased(spark, MIXED), none).count() == 0


def test_history_answers(spark):
    items = aliased(spark, [("o", "a", "main", "x"), ("o", "a", "bad", "x"), ("o", "gone", "m", "x"), ("o", "a", "main", "y"), ("o", "a", "main", "z")])
    node = {"oid": "0123456789abcdef", "messageHeadline": "m" * 90, "committedDate": "2024-01-01T00:00:00Z", "author": None}
    body = {"data": {"r0": {"ref0": {"f0": {"nodes": [node]}, "f1": None, "f2": {"nodes": []}}, "ref1": None}, "r1": None}}
    answers = spark.createDataFrame([(0, json.dumps(body))], "batch_id long, body string")
    got = responses.history_answers(items, answers)
    errors = {r.pos: r.e for r in got.select("pos", responses.history_error().alias("e")).collect()}
    assert errors == {0: None, 1: "bad_ref", 2: "not_found", 3: "no_history", 4: None}
    flat = {r.url: r.commits for r in responses.flatten_history(got).collect()}
    assert flat["u4"] == []
    commit = flat["u0"][0]
    assert (commit.sha, commit.author, commit.date, commit.message) == ("0123456", None, "2024-01-01T00:00:00Z", "m" * 80)


def test_metadata_answers(spark):
    items = spark.createDataFrame([(0, 0, "o/r"), (0, 1, "o/gone"), (0, 2, "o/bare")], "batch_id long, pos int, repo_key string")
    full = {
        "stargazerCount": 100, "forkCount": 20, "watchers": {"totalCount": 50}, "primaryLanguage": {"name": "Python"},
        "repositoryTopics": {"nodes": [{"topic": {"name": "ai"}}, {"topic": None}, {"topic": {"name": "x"}}]},
        "createdAt": "2024-01-01T00:00:00", "updatedAt": None, "pushedAt": None, "defaultBranchRef": {"name": "main"},
        "licenseInfo": {"spdxId": "MIT"}, "description": "d",
    }
    body = {"data": {"r0": full, "r1": None, "r2": {"stargazerCount": 1, "watchers": None}}}
    answers = spark.createDataFrame([(0, json.dumps(body))], "batch_id long, body string")
    got = responses.metadata_answers(items, answers)
    errors = {r.repo_key: r.e for r in got.select("repo_key", responses.metadata_error().alias("e")).collect()}
    assert errors == {"o/r": None, "o/gone": "not_found", "o/bare": None}
    rows = {r.repo_key: r for r in responses.flatten_metadata(got).collect()}
    assert rows["o/r"].asDict() == {
        "repo_key": "o/r", "stars": 100, "forks": 20, "watchers": 50, "language": "Python", "topics": ["ai", "x"],
        "created_at": "2024-01-01T00:00:00", "updated_at": None, "pushed_at": None, "default_branch": "main",
        "license": "MIT", "description": "d",
    }
    assert rows["o/bare"].topics == [] and rows["o/bare"].watchers is None


def test_single_file_outcomes(spark):
    rows = [
        (200, None, "", False, "fetched"),
        (200, None, "eA==", False, "fetched"),
        (200, "unresolvable_symlink", None, False, "not_found"),
        (200, "no_content", None, False, "not_found"),
        (404, None, None, False, "not_found"),
        (200, None, None, True, "not_found"),
        (502, None, None, False, "error"),
        (None, None, None, False, "error"),
    ]
    df = spark.createDataFrame(rows, "status int, error string, content string, folder boolean, want string")
    got = df.select("want", responses.single_outcome(F.col("status"), F.col("error"), F.col("content"), F.col("folder")).alias("o"))
    assert all(r.want == r.o for r in got.collect())


def test_dispositions(spark):
    rows = [(200, "", "success", "success"), (204, "", "success", "terminal"), (429, "", "rate_limited", "rate_limited"),
            (403, "API rate limit exceeded", "rate_limited", "rate_limited"), (403, "no access", "terminal", "rate_limited"),
            (404, "", "terminal", "terminal"), (502, "", "retryable", "retryable")]
    df = spark.createDataFrame(rows, "s int, b string, single string, batch string")
    got = df.select("single", "batch", responses.rest_disposition(F.col("s"), F.col("b")).alias("x"), responses.batch_disposition(F.col("s")).alias("y"))
    assert all((r.single, r.batch) == (r.x, r.y) for r in got.collect())


def test_decoded_text_marks_broken_rows(spark):
    df = spark.createDataFrame([("IyBUZXN0IEZpbGU=",), ("abc",)], "content string")
    assert [r.text for r in responses.decoded_content(df).collect()] == ["# Test File", None]
    assert text.CLIP_LENGTH == 10_000
