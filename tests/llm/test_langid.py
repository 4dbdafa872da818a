import numpy as np
from pyspark.sql import functions as F

from gleanery.llm.langid import DIMENSIONS, LanguageModel, family_of, features, identify, linear_svm, train
from gleanery.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf, documents):
    found = QUERIES["op9_language"](spark, sf).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(held) > 20 and len(found) == documents.count()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_families_first_then_duels():
    texts = {"en": "the thing with that", "de": "und nicht der schon", "fr": "le que dans pour", "es": "el que los para", "zz": "qqq xxq"}
    x = features([f"{t} {t}"[i:] for t in texts.values() for i in range(5)])
    model = LanguageModel(x, [lang for lang in texts for _ in range(5)])
    assert model.families == sorted({"germanic", "romance", "only zz"}) and set(model.pairs) == {("de", "en"), ("es", "fr")}
    names, scores = model.predict(features(list(texts.values())))
    assert names == list(texts) and ((scores > 0) & (scores <= 1)).all()
    assert family_of("de") == "germanic" and family_of("??") == "only ??"


def test_machine_separates_and_is_deterministic():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(1, 1, (40, 5)), rng.normal(-1, 1, (20, 5))])
    y = np.repeat([1.0, -1.0], [40, 20])
    w = linear_svm(x, y)
    assert (np.sign(np.hstack([x, np.ones((60, 1))]) @ w) == y).mean() > 0.95 and (w == linear_svm(x, y)).all()


def test_long_texts_are_counted_whole(monkeypatch):
    text = "der die das " * 3000 + "xyz"
    whole = features([text])
    monkeypatch.setattr("gleanery.llm.langid._BLOCK", 1000)
    assert np.abs(features([text]) - whole).max() < 0.01 and whole.shape == (1, DIMENSIONS)


def test_odd_rows(odd, none):
    found = identify(odd.withColumn("Score", F.lit("x")), train(odd)).collect()
    assert len(found) == odd.count()
    for r in found:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "de", "fr") and 0 < r.score <= 1
    assert train(none) is None and train(odd.withColumn("lang", F.lit(None).cast("string"))) is None
    assert identify(none, train(odd)).collect() == []
    assert {r.lang_pred for r in identify(odd, None).collect()} == {"und"}


def test_a_filter_on_the_result_does_not_predict_twice(spark, documents):
    from gleanery.llm.langid import identify, train

    kept = identify(documents, train(documents.limit(100))).filter("lang_pred <> 'und' AND score > 0.2")
    plan = spark._jvm.PythonSQLUtils.explainString(kept._jdf.queryExecution(), "simple")
    assert plan.count("ArrowEvalPython") == 1


def test_training_rows_are_those_with_the_smallest_hashes(spark):
    from gleanery.llm.langid import training_rows

    texts = [(f"{lang} word{i % 900}", lang) for lang, n in (("en", 2000), ("de", 30)) for i in range(n)]
    docs = spark.createDataFrame(texts, "text string, lang string").withColumn("key", F.xxhash64("text"))
    want = {lang: sorted({r.key for r in docs.collect() if r.lang == lang})[:50] for lang in ("en", "de")}
    got = training_rows(docs, sample=50).collect()
    assert {lang: sorted(r.key for r in got if r.lang == lang) for lang in want} == want
