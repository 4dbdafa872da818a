import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import toxicity
from gleanery.llm.queries import QUERIES
from gleanery.llm.toxicity import DISCOUNT, LEAST_SYMBOLS, ORDER, features, score, train, words_of

_ALPHABET = "abcdeé你ß𐐨1"


def _texts(n, seed):
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choices(_ALPHABET, k=pick.randint(1, 9))) for _ in range(60)]
    return [" ".join(pick.choices(vocabulary, k=pick.randint(1, 40))) + pick.choice(["", "!", " _ -"]) for _ in range(n)]


def _grams(text):
    padded = [" " * (ORDER - 1) + w + " " for w in words_of(text)]
    return [p[i:i + ORDER] for p in padded for i in range(len(p) - ORDER + 1)]


def _estimate(counts):
    once, twice = (sum(c == i for c in counts) for i in (1, 2))
    return min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.75


class PlainModel:
    """The same model by recursion over dictionaries."""

    def __init__(self, texts, toxic, ordinary):
        self.levels = {ORDER: Counter(g for t in texts for g in _grams(t))}
        for k in range(ORDER - 1, 0, -1):
            self.levels[k] = Counter(g[1:] for g in self.levels[k + 1])
        self.d = {k: _estimate(level.values()) for k, level in self.levels.items()}
        self.sides = [Counter(g for t in side for g in _grams(t)) for side in (toxic, ordinary)]

    def shared(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / len(self.levels[1])
        same = [c for g, c in self.levels[k].items() if g[:-1] == gram[:-1]]
        kept = max(self.levels[k][gram] - self.d[k], 0) / sum(same)
        return kept + self.d[k] * len(same) / sum(same) * self.shared(gram[1:])

    def p(self, side, gram):
        same = [c for g, c in side.items() if g[:-1] == gram[:-1]]
        if not same:
            return self.shared(gram)
        return (max(side.get(gram, 0) - DISCOUNT, 0) + sum(min(c, DISCOUNT) for c in same) * self.shared(gram)) / sum(same)

    def ratio(self, gram):
        toxic, ordinary = self.sides
        return math.log(self.p(toxic, gram)) - math.log(self.p(ordinary, gram))


@pytest.fixture(scope="module")
def corpus(spark):
    texts = _texts(120, 1)
    marks = [(i, int(i % 5 == 0)) for i in range(0, 120, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    plain = PlainModel(texts, [texts[i] for i, y in marks if y], [texts[i] for i, y in marks if not y])
    return texts, docs, labels, plain


def test_ratios_against_plain_kneser_ney(corpus):
    texts, docs, labels, plain = corpus
    values = {r.key: r.v for r in train(docs, labels).keys.collect()}
    grams = set(plain.levels[ORDER])
    assert set(values) == grams | {g[:-1] for g in grams} and any(abs(values[g]) > 0.1 for g in grams)
    for gram in grams:
        assert abs(values[gram] + values[gram[:-1]] - plain.ratio(gram)) < 1e-9, gram
    symbols = list(plain.levels[1])
    for context in sorted({g[:-1] for g in grams})[:20]:
        for side in plain.sides:
            assert abs(sum(plain.p(side, context + s) for s in symbols) - 1) < 1e-9


@pytest.mark.parametrize("head", [0, 40, 1 << 17])
def test_features_do_not_depend_on_the_head(corpus, head):
    texts, docs, labels, plain = corpus
    model = train(docs, labels, head=head)
    twice = docs.unionAll(docs.limit(30))
    for r in features(twice, model).collect():
        words = words_of(r.text)
        each = {w: sum(plain.ratio(g) for g in _grams(w)) for w in set(words)}
        symbols = sum(len(w) + 1 for w in words)
        assert abs(r._mean - sum(each[w] for w in words) / symbols) < 1e-9
        assert abs(r._most - max(v / max(len(w) + 1, LEAST_SYMBOLS) for w, v in each.items())) < 1e-9


def test_counts_grow_with_the_corpus(spark):
    texts, sizes = [], []
    for n in (50, 200):
        texts += _texts(n, n) + ["word" * 400 + str(n)]
        docs = spark.createDataFrame([(t,) for t in texts], "text string")
        counted = {r.gram: r.n0 for r in toxicity._count(docs, 1, F.lit(0), "text").collect()}
        assert counted == Counter(g for t in texts for g in _grams(t))
        sizes.append(len(counted))
    assert sizes[0] < sizes[1]


def test_runs_and_the_head_against_a_dictionary(monkeypatch):
    words = sorted({w for t in _texts(30, 5) for w in words_of(t)} | {"a", "b" * 900})
    keys = sorted({k for w in words for g in _grams(w) for k in (g, g[:-1])})
    pick = random.Random(3)
    values = {k: pick.uniform(-2, 2) for k in keys if pick.random() < 0.7}
    head = toxicity.Head(list(values), list(values.values()))
    monkeypatch.setattr(toxicity, "_RUN", 40)
    runs = list(toxicity._runs(words))
    assert [w for r in runs for w in r] == words and len(runs) > 10
    for run in (words, *runs):
        found, open_, lacking, names = head.words(run)
        missing = [(run[i], k) for i, k in zip(lacking.tolist(), names)]
        plain = [(w, k) for w in run for g in _grams(w) for k in (g, g[:-1]) if k not in values]
        assert Counter(missing) == Counter(plain) and [w for w, o in zip(run, open_) if o] == [w for w in run if w in dict(plain)]
        sums = [sum(values.get(k, 0) for g in _grams(w) for k in (g, g[:-1])) for w in run]
        assert np.allclose(found, sums, atol=1e-9)
    found, open_, lacking, names = toxicity.Head([], []).words(["ab"])
    assert found.tolist() == [0] and open_.all() and len(names) == 6


def test_held_out_ranking(spark):
    sf = "/root/testdata/sf0.01"
    words = {"disgusting", "stupid", "loser", "pathetic", "moron", "worthless", "clown", "idiot", "scum", "trash"}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [r for r in QUERIES["op7_toxicity"](spark, sf).join(docs, "doc_id").collect() if r.held_out]
    bad = [bool(words & set(r.text.lower().replace(",", " ").replace(".", " ").split())) for r in rows]
    score_of = np.array([r.score for r in rows])
    rank = score_of.argsort().argsort()[np.array(bad)]
    n = sum(bad)
    assert (rank.mean() - (n - 1) / 2) / (len(rows) - n) > 0.95
    clean = score_of[~np.array(bad)]
    assert (clean >= 0.7).mean() < 0.01 and all(r.predicted == (r.score >= 0.7) for r in rows)


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (4, 1), (5, 0), (7, 0), (9, 1), (None, 1), (8, None)], "doc_id bigint, toxic int")
    model = train(odd, labels)
    rows = score(odd.withColumn("Predicted", F.lit("x")), model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    half = train(none, labels)
    assert {r.score for r in score(odd, half).collect()} == {0.5} and score(none, model).collect() == []


def test_repeated_rows_do_not_push_others_out_of_the_calibration(spark):
    calm, rude = ("a calm note on rivers", "a calm day in spring"), ("you stupid moron", "stupid stupid loser")
    texts = dict(enumerate([*calm, *rude] * 10))
    rows = [*texts.items()] + [(0, texts[0])] * 30
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(t in rude)) for i, t in texts.items()], "doc_id bigint, toxic int")
    model = train(docs, labels, sample=40)
    found = {r.text: r.score for r in score(docs, model).collect()}
    assert model.weights.any() and min(found[t] for t in rude) > max(found[t] for t in calm)


def test_texts_are_read_once_to_be_scored(corpus, monkeypatch):
    """Sums of a text are worked out once, however often the result is read, with words forgotten in between."""
    texts, docs, labels, plain = corpus
    model = train(docs, labels, head=40)
    counter = docs.sparkSession.sparkContext.accumulator(0)
    first = F.udf(lambda t: counter.add(1) or t)
    found = features(docs.select("doc_id", first("text").alias("text")), model, keep_text=False)
    assert "text" not in found.columns
    assert {r.doc_id: r._most for r in found.collect()} == {r.doc_id: r._most for r in found.collect()}
    assert counter.value <= 2 * len(texts)  # a hash and the sums may each ask for a text
    monkeypatch.setattr(toxicity, "_HELD", 5)
    monkeypatch.setattr(toxicity, "_RUN", 30)
    keys = {k for g in plain.levels[ORDER] for k in (g, g[:-1]) if ord(g[0]) % 9 or " " in g}
    head = toxicity.Head(sorted(keys), [float(len(k)) for k in sorted(keys)])
    words, none = [words_of(t) for t in texts], np.zeros(0)
    rows = list(toxicity._sums_of_texts(head, iter([[], *words, []]), toxicity._Known(), [none, none.astype(bool), none.astype(int)]))
    assert rows[0] == rows[-1] == {"total": 0.0, "symbols": 0, "most": None, "rest": []}
    for found, own in zip(rows[1:], words):
        sums, open_ = head.sums(own)
        closed = [v / max(len(w) + 1, LEAST_SYMBOLS) for w, v, o in zip(own, sums, open_) if not o]
        assert abs(found["total"] - sums[~open_].sum()) < 1e-9 and found["symbols"] == sum(len(w) + 1 for w in own)
        assert found["most"] == (max(closed) if closed else None)
        assert Counter({r["word"]: r["times"] for r in found["rest"]}) == Counter(w for w, o in zip(own, open_) if o)
