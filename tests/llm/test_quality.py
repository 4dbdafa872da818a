import re
from collections import Counter
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm.quality import BINS, RULES, binomial_cdf, cutoffs, judge, measure, quality
from gleanery.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("text", [
    None, "", " \n\n", "a", "a b", "a b c", "a a a a", "a b c a b c", "é日 #*| é日\n\né日 #*| é日", "x\x1cy z\x85 q\xa0r", "a b\n" * 500,
])
def test_measures(text):
    assert measure(text)[:5] == plain(text)


def test_query_base(spark, sf, documents):
    got = {r.doc_id: r for r in QUERIES["op8_quality"](spark, sf).collect()}
    for r in documents.collect():
        want, row = plain(r.text), got[r.doc_id]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        assert row.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (row.base_failed and row.kept)


def test_binomial_bound_is_exact():
    for n, p in ((1, 0.3), (30, 0.01), (400, 0.02), (50, 0.9)):
        k = np.arange(-1, n + 2)
        want = [sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(0, min(a, n) + 1)) for a in k]
        assert np.allclose(binomial_cdf(k, np.full(len(k), n), p), want, rtol=1e-9, atol=1e-12)


def _measured(spark, rows):
    names = "doc_id bigint, lang string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, " \
            "n_repeat_words bigint, n_upper bigint, n_letters bigint, n_lines bigint, base_failed boolean"
    return spark.createDataFrame([(i, lang, 100, 500, sym, 0, 0, 0, 400, 5, False) for i, (lang, sym, _) in enumerate(rows)], names)


def test_cutoffs_keep_to_the_risk(spark):
    """One language with a clear limit, one where good documents look like bad ones, one with few labels."""
    rows = [("en", 0, 1)] * 1500 + [("en", 60, 0)] * 200 + [("de", 50, 1)] * 1500 + [("de", 50, 0)] * 200 + [(None, 0, 1)] * 5 + [(None, 90, 0)] * 5
    measured = _measured(spark, rows)
    labels = spark.createDataFrame([(i, q) for i, (_, _, q) in enumerate(rows)], "doc_id bigint, quality int")
    found = {(r.stratum, r.rule): r.cutoff for r in cutoffs(measured, labels).collect()}
    assert set(found) == {("en", "symbols")} and found["en", "symbols"] < BINS
    kept = judge(measured, cutoffs(measured, labels)).groupBy("lang", "n_symbols").agg(F.min("kept").alias("k"), F.max("kept").alias("m"))
    assert {(r.lang, r.n_symbols): (r.k, r.m) for r in kept.collect()} == {
        ("en", 0): (True, True), ("en", 60): (False, False), ("de", 50): (True, True), (None, 0): (True, True), (None, 90): (True, True),
    }
    assert len(RULES) == 5


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 1), (5, 0), (None, 1), (6, None), (99, 1)], "doc_id bigint, quality int")
    rows = quality(odd.withColumn("Kept", F.lit("x")), labels).collect()
    assert len(rows) == odd.count() and all(r.kept == (not r.base_failed) for r in rows)
    assert quality(none, labels).collect() == []
    assert quality(odd, labels.limit(0)).count() == odd.count()
