import base64
import hashlib
import json
import posixpath

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.functions import commits, keys, text, urls


def one(spark, expression, **values):
    """The value of one expression over one row of strings (or arrays of them)."""
    kinds = {k: "array<string>" if isinstance(v, list) else "string" for k, v in values.items()}
    schema = ", ".join(f"{k} {kind}" for k, kind in kinds.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "url, parts",
    [
        ("https://github.com/owner/repo/blob/main/path/to/file.md", ("owner", "repo", "main", "path/to/file.md")),
        ("https://github.com/owner/repo/blob/main/file.md", ("owner", "repo", "main", "file.md")),
        ("https://github.com/owner/repo/blob/feat/branch/file.md", ("owner", "repo", "feat", "branch/file.md")),
        ("https://gitlab.com/owner/repo/blob/main/file.md", None),
        ("https://github.com/owner/repo/tree/main/file.md", None),
        ("https://github.com/owner/repo", None),
        ("HTTPS://github.com/owner/repo/blob/main/file.md", None),
        (None, None),
    ],
)
def test_file_urls(spark, url, parts):
    kept = one(spark, urls.is_file_url(F.col("u")), u=url)
    assert kept is (parts is not None)
    if parts:
        named = urls.url_parts(urls.url_segments(F.col("u")))
        assert tuple(one(spark, F.struct(*named.values()), u=url)) == parts


@pytest.mark.parametrize(
    "url, key",
    [
        ("https://github.com/o/r/blob/main/x", "o/r"),
        ("https://GitHub.com/o/r/tree", "o/r"),
        ("https://github.com/o/r", "o/"),
        ("https://github.com/o/", "o/"),
        ("https://github.com/o", "//"),
        ("https://github.com//x/y", "/x"),
    ],
)
def test_repo_key(spark, url, key):
    assert one(spark, urls.on_host(F.col("u")), u=url)
    assert one(spark, urls.repo_key(F.col("u")), u=url) == key


def test_query_texts(spark):
    assert one(spark, urls.ranged_query(F.col("q"), F.lit(5), F.lit(14)), q="filename:x") == "filename:x size:5..14"
    assert one(spark, urls.base_query(F.col("q")), q="filename:x size:5..14") == "filename:x"
    assert one(spark, urls.sent_query(F.col("q")), q="a+b c") == "a b c"
    assert one(spark, urls.rooted_endpoint(F.col("q")), q="repos/x") == "/repos/x"
    assert one(spark, urls.rooted_endpoint(F.col("q")), q="/repos/x") == "/repos/x"


def test_params_first_equals_and_last_wins(spark):
    got = one(spark, urls.params_map(F.col("a")), a=["a=1", "b=x=y", "a=2", "c"])
    assert got == {"a": "2", "b": "x=y", "c": ""}


@pytest.mark.parametrize(
    "path, target",
    [("d/f1", "../d/./f0"), ("a", "b"), ("a/b/c", "../../../x"), ("a/b", ".."), ("x/y", "./"), ("a", "../b/../c")],
)
def test_link_destination(spark, path, target):
    want = posixpath.normpath(posixpath.join(posixpath.dirname(path), target))
    assert one(spark, urls.link_destination(F.col("p"), F.col("t")), p=path, t=target) == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=12), min_size=1, max_size=20))
def test_request_key_matches_json(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, s string")
    params = {"s": F.col("s"), "b": F.col("i"), "n": F.lit(None).cast("string")}
    got = df.select("i", keys.request_key("contents", params, ("b",)).alias("k")).collect()
    for row in got:
        text_form = json.dumps({"s": values[row.i], "b": row.i, "n": None}, sort_keys=True)
        assert row.k == hashlib.sha256(f"contents|{text_form}".encode()).hexdigest()[:16]


def test_free_and_batched_call_keys(spark):
    def digest(endpoint, params):
        return hashlib.sha256(f"{endpoint}|{json.dumps(params, sort_keys=True)}".encode()).hexdigest()[:16]

    params = {"q": 'a "b" é', "per_page": "10", "a": ""}
    df = spark.createDataFrame([("repos/x", params)], "e string, p map<string,string>")
    got = df.select(
        keys.call_key(F.col("e"), F.col("p")).alias("call"),
        keys.call_key(F.concat(F.lit("/"), F.col("e")), F.create_map().cast("map<string,string>")).alias("bare"),
        keys.batch_key(F.lit('query {\n  x(a: "b")\n}')).alias("batch"),
        keys.batch_key(F.lit("q"), F.lit('{"n": 1}')).alias("bound"),
    ).first()
    assert got.call == digest("repos/x", params)
    assert got.bare == digest("/repos/x", {})
    assert got.batch == digest("graphql", {"query": 'query {\n  x(a: "b")\n}', "variables": {}})
    assert got.bound == digest("graphql", {"query": "q", "variables": {"n": 1}})


@pytest.mark.parametrize(
    "content",
    [
        base64.b64encode(b"abc\xff\xfe\xe9x").decode(),
        base64.encodebytes(b"# Test File\n" * 20).decode(),
        "IyBUZXN0IEZpbGU=",
        "@@YWJj@@",
        " Y W J j ",
        "YWJj\r\nYWJj\r\n",
        "",
        base64.b64encode(b"\xe2\x82").decode(),
        base64.b64encode(b"\xf0\x9f\x98a\xc0\x80").decode(),
    ],
)
def test_decoded_text(spark, content):
    want = base64.b64decode(content).decode("utf-8", errors="replace")
    assert one(spark, text.decoded_text(F.col("c")), c=content) == want


@pytest.mark.parametrize("content", ["abc", "!!!notb64", None])
def test_undecodable_content_is_null(spark, content):
    assert one(spark, text.decoded_text(F.col("c")), c=content) is None


def test_encoded_text_is_one_line(spark):
    long = "é" * 500
    assert one(spark, text.encoded_text(F.col("t")), t=long) == base64.b64encode(long.encode()).decode()


def test_report_cells(spark):
    assert one(spark, text.short_url(F.col("u")), u="https://github.com/a/b") == "a/b"
    long = "https://github.com/" + "a" * 40 + "b" * 40
    assert one(spark, text.short_url(F.col("u")), u=long) == "a" * 28 + "..." + "b" * 28
    assert one(spark, text.short_text(F.col("t")), t="short") == "short"
    words = "word " * 40
    assert one(spark, text.short_text(F.col("t")), t=words) == words[:117].rsplit(" ", 1)[0] + "..."
    solid = "x" * 200
    assert one(spark, text.short_text(F.col("t")), t=solid) == "x" * 117 + "..."
    assert one(spark, text.cell_escaped(F.col("t")), t='<a href="x">&|') == "&lt;a href=&quot;x&quot;&gt;&amp;&#124;"
    assert one(spark, text.clipped_text(F.col("t"), 3), t="abcd") == "abc\n\n[truncated]"
    assert one(spark, text.clipped_text(F.col("t"), 4), t="abcd") == "abcd"


def test_commit_fields(spark):
    assert one(spark, commits.first_line(F.col("m")), m="head " * 30 + "\nbody") == ("head " * 30)[:80]
    assert one(spark, commits.headline(F.col("m")), m=None) == ""
    assert one(spark, commits.short_sha(F.col("o")), o="0123456789") == "0123456"
