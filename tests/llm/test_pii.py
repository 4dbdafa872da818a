import random
import re
from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from gleanery.llm.pii import (
    ABSTAIN, NO, YES, SpanModel, base_spans, count_votes, expectation_maximisation, find_spans, loose_spans, luhn, redact, train,
)
from gleanery.llm.queries import QUERIES

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
                    "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))}[kind]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_fixed_patterns_against_plain_search():
    draw = random.Random(3)
    for _ in range(20000):
        text = "".join(draw.choice("a1@.+- ()_%9é4") for _ in range(draw.randrange(40)))
        assert base_spans(text) == plain(text), text


def test_query(spark, sf, documents):
    got = {r.doc_id: r for r in QUERIES["op6_pii"](spark, sf).collect()}
    for r in documents.collect():
        spans = plain(r.text)
        line = ",".join(f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in spans)
        assert got[r.doc_id].base_sha256 == sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(got[r.doc_id].spans.split(","))
        assert got[r.doc_id].n_phone == sum(k == 3 for _, k, _ in spans)


def test_votes_find_the_unreliable_labeler():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.4
    votes = np.array([[YES if t ^ (rng.random() < e) else NO for e in (0.05, 0.1, 0.5)] for t in truth])
    votes[rng.random(votes.shape) < 0.2] = ABSTAIN
    p, reliability = expectation_maximisation(votes, np.ones(len(votes)))
    assert ((p > 0.5) == truth).mean() > 0.9
    right = reliability[:, 1, YES] / reliability[:, 1, [YES, NO]].sum(1)
    assert right[0] > 0.85 and right[1] > 0.8 and abs(right[2] - 0.5) < 0.1


def test_added_spans_and_redaction(spark):
    texts = [
        "call me, phone (415) 555-2671 today", "order 4111 1111 1111 1111 5500 0000 0000 0004 paid by card",
        "mail jo (at) example (dot) com", "version 415-555-2671-9", "a@b.example 10.0.0.1 +1 (415) 555-2671", None, "",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    assert loose_spans(texts[0], []) == [(15, 3, 29)] and loose_spans(texts[4], base_spans(texts[4])) == []
    found = {r.doc_id: r for r in redact(find_spans(docs, train(docs))).collect()}
    assert found[4].text == "[EMAIL] [IP] [PHONE]" and all(s.base for s in found[4].spans)
    assert "415" not in found[0].text and not found[0].spans[0].base
    assert "4111" not in found[1].text
    assert found[5].text is None and found[6].text == "" and found[5].spans == []


def test_counts_are_bounded_and_complete(documents):
    rows = count_votes(documents).collect()
    spans = sum(len(plain(r.text)) for r in documents.collect())
    assert sum(r.n for r in rows) >= spans > 0
    model = SpanModel([(r.kind, r.votes, r.bits, r.n) for r in rows])
    assert all(0 <= model.score(k, b) <= 1 for k in range(4) for b in range(128))


def test_odd_rows(odd, none):
    found = find_spans(odd.withColumn("SPANS", F.lit(1)), train(odd))
    assert found.count() == odd.count() and redact(found).count() == odd.count()
    assert find_spans(none, train(none)).collect() == []
    assert base_spans("7" * 200000 + " " + "a@" * 50000 + " " + "1.." * 50000 + "x " + "+1" * 50000) == []


def test_hidden_addresses_in_any_case():
    for at, dot in (("(at)", "(dot)"), ("(At)", "(Dot)"), ("[aT]", "[DOT]"), ("(AT)", ".")):
        text = f"write to jo {at} mail {dot} org today"
        assert [(text[a:b], k) for a, k, b in loose_spans(text, [])] == [(f"jo {at} mail {dot} org", 0)]
