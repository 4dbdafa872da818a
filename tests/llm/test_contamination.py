import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from gleanery import llm
from gleanery.llm.contamination import decontaminate, phrases, store_postings

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window=10):
    """(words, hit words, ids) of each text, window by window."""
    out = []
    for text in docs:
        words, hit, ids = split(text), set(), set()
        for item, body in items:
            terms = split(body)
            size = min(window, len(terms))
            wanted = {tuple(terms[i:i + size]) for i in range(len(terms) - size + 1)} if size else set()
            for i in range(len(words) - size + 1) if size else ():
                if tuple(words[i:i + size]) in wanted:
                    hit |= set(range(i, i + size))
                    ids |= {str(item)} if item is not None else set()
        out.append((len(words), len(hit), sorted(ids)))
    return out


def check(spark, docs, items, **options):
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate(rows, tests, **options).collect()}
    want = dict(enumerate(plain(docs, items)))
    assert got == want
    return want


def test_random_texts_with_pieces_of_items(spark):
    draw = random.Random(4)
    word = lambda: "w%d" % min(draw.randrange(1, 400) for _ in range(3))  # noqa: E731  some terms are frequent
    items = [(i, " ".join(word() for _ in range(draw.choice((1, 2, 4, 9, 10, 11, 25, 60))))) for i in range(40)]
    items += [(3, items[5][1]), (None, items[6][1]), (41, ""), (42, None), (43, "the " * 14), (44, "-- !")]
    docs = []
    for _ in range(150):
        parts = []
        for _ in range(draw.randrange(0, 6)):
            terms = split(draw.choice(items)[1])
            at = draw.randrange(0, max(1, len(terms)))
            parts += terms[at:at + draw.randrange(1, 30)] + [word() for _ in range(draw.randrange(0, 20))]
        docs.append(draw.choice((" ", ", ", "\n")).join(draw.choice((str.upper, str.lower))(p) for p in parts))
    docs += ["the " * 50, "the " * 13 + "a " + "THE " * 9, docs[0], docs[0], "é É ß"]
    want = check(spark, docs, items)
    assert sum(n > 0 for _, n, _ in want.values()) > 50 and sum(n == 0 for _, n, _ in want.values()) > 10


def test_passage_that_many_documents_share(spark):
    """A third of all rows are copies of one text; their lists are not dealt by term or text."""
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [passage + f" end{i}" if i % 3 else passage for i in range(300)] + ["p1 p2 p3", "q " * 2000 + passage]
    want = check(spark, docs, [(1, passage), (2, "p0 " + passage)])
    assert want[301] == (2030, 30, ["1", "2"])


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "alpha0 beta5"), (2, None), (None, "x" * 30000), (3, "日本")], "item_id bigint, text string")
    found = decontaminate(odd.withColumn("ITEMS", F.lit(1)).withColumn("doc", F.lit(2)), items, near=True)
    rows = found.collect()
    assert len(rows) == odd.count() and {r.doc for r in rows} == {2}
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert all(by_id[i].n_words == 0 and not by_id[i].contaminated and by_id[i]["items"] == [] for i in (1, 2, 3))
    assert by_id[8].n_hit == 1 and by_id[8].n_items == 0 and by_id[9]["items"] == ["3"]
    assert by_id[7].n_words == 30000
    assert decontaminate(none, items).collect() == []
    empty = decontaminate(odd, items.limit(0)).collect()
    assert len(empty) == len(rows) and not any(r.contaminated for r in empty)


def test_terms_near_each_other(spark):
    items = [(1, "a1 b1 c1 d1"), (2, "solo"), (3, "r1 r1 r2"), (4, "zz a1")]
    docs = ["d1 x b1 y c1 " + "z " * 5 + "a1", "a1 b1 c1 " + "z " * 30 + "d1", "r2 r1", "r2 " + "z " * 25 + "r1", "solo", "zz " + "q " * 19 + "a1"]
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: r.near_items for r in decontaminate(rows, tests, near=True).collect()}
    assert got == {0: ["1"], 1: [], 2: ["3"], 3: [], 4: ["2"], 5: ["4"]}


def test_index_holds_all_terms(spark, documents):
    docs, postings = store_postings(documents.select("doc_id", "text"))
    assert postings.count() == docs.agg(F.sum("n_words")).first()[0] == sum(len(split(r.text)) for r in documents.collect())
    assert docs.columns[0] == "doc_id" and postings.columns == ["term", "doc", "pos"]
    places, named = phrases(spark.createDataFrame([(1, "A b"), (2, "a B"), (2, "a B")], "item_id bigint, text string"))
    assert places.count() == 2 and sorted(r["item"] for r in named.collect()) == ["1", "2"]


@pytest.mark.parametrize("table", ["sf0.001"])
def test_query_against_brute_force(spark, table):
    sf = f"/root/testdata/{table}"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    want = plain([r.text for r in docs], [(r.item_id, r.text) for r in items])
    got = {r.doc_id: r for r in llm.all_queries()["op13_decontamination"](spark, sf).collect()}
    for doc, (words, hit, ids) in zip(docs, want):
        r = got[doc.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (words, hit, len(ids), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
    assert any(ids for _, _, ids in want)
