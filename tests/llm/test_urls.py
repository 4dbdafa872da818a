import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from gleanery.llm.queries import CHECKS
from gleanery.llm.urls import Automaton, Rule, judge, split_url


def as_pattern(glob):
    parts = {"*": "[^/?]*", "**": ".*", "?": "[^/]"}
    return re.compile("".join(parts.get(t) or re.escape(t[-1]) for t in Automaton._tokens(glob)), re.S)


def test_automaton_is_the_same_as_patterns():
    draw = random.Random(1)
    globs = ["".join(draw.choice(["a", "b", "/", "*", "**", "?", "\\?", "."]) for _ in range(draw.randrange(1, 9))) for _ in range(60)]
    globs += ["**" + "ab" * 70 + "*", "a" * 64 + "**b"]
    urls = ["".join(draw.choice("ab/.?") for _ in range(draw.randrange(12))) for _ in range(400)] + ["", "ab" * 75, "a" * 64 + "b"]
    automaton = Automaton(globs)
    assert automaton.words > 2
    found = automaton.matches([u.encode() for u in urls])
    for i, u in enumerate(urls):
        assert [bool(x) for x in found[i]] == [bool(as_pattern(g).fullmatch(u)) for g in globs], u


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("no scheme/net/", "", "", None, "allow"),
    ("http://NET/x", "net", "/x", "net/", "block"),
    ("http://a.net", "a.net", "", None, "allow"),
    ("http://a.net?q=/", "a.net", "", None, "allow"),
    ("http://a.com?u=b.net/x", "a.com", "", None, "allow"),
    ("http://a.com/b.net/x", "a.com", "/b.net/x", None, "allow"),
    ("http://anet/x", "anet", "/x", None, "allow"),
    ("https://m.Example.NET/en/1?a#b", "m.example.net", "/en/1", "example.net/en/", "allow"),
    ("https://example.net/EN/1", "example.net", "/EN/1", "net/", "block"),
    ("https://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    ("https://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    ("https://x.org/fr/#http://y.net/", "x.org", "/fr/", "org/fr/", "allow"),
    ("http://spam-farm.example.org/en", "spam-farm.example.org", "/en", None, "block"),
    ("http://spam-farm.example.org/fr/", "spam-farm.example.org", "/fr/", "org/fr/", "allow"),
    ("http://é.net/ü", "é.net", "/ü", "net/", "block"),
    ("http://a.net:80/x", "a.net:80", "/x", None, "allow"),
    ("http://" + "a" * 50000 + ".net/" + "b" * 50000, "a" * 50000 + ".net", "/" + "b" * 50000, "net/", "block"),
])
def test_rules(spark, url, host, path, rule, verdict):
    row = judge(spark.createDataFrame([(1, url)], "page_id bigint, url string")).first()
    assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)
    assert split_url(url)[:2] == (host, path)


def test_query_sql_and_odd_rows(spark, sf):
    urls = ["http://a.net/x", None, None, "://", "a://b?", "http://x.com/a.exe", "http://x.com/?a&sessionid=3"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    want = con.execute(CHECKS["op5_urls"]).fetchall()
    got = judge(pages.withColumn("Host", F.lit(1))).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert judge(pages.limit(0)).collect() == []
    own = judge(pages, rules=[Rule("block", "x.com", "/a*")], globs=[])
    assert {r.verdict for r in own.collect()} == {"allow"}  # a star in a rule is a star
