import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from gleanery.llm.pii import base_spans
from gleanery.llm.queries import vocabulary_path
from gleanery.session import checkpointed

from .test_nearcopies import plain_groups


@pytest.fixture(scope="module")
def steps(spark, sf, documents):
    found = [("documents", documents)]
    for name, stage in corpus_pipeline.STAGES:
        found.append((name, checkpointed(stage(spark, found[-1][1], sf))))
    return {name: df for name, df in found}


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_against_plain_python(steps, documents):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mixing", "encoding"]
    for name in ("language", "near_duplicates", "personal_data", "mixing"):
        assert steps[name].columns == documents.columns
    every, known, single, clean = (rows(steps[n]) for n in ("documents", "language", "near_duplicates", "personal_data"))
    assert set(known) == {d for d, r in every.items() if any(c.isalpha() for c in r.text or "")}
    assert sum(known[d].lang == every[d].lang for d in known) / len(known) > 0.97
    groups = plain_groups({d: r.text for d, r in known.items()})
    assert set(single) == set(groups.values()) and all(single[d].text == every[d].text for d in single)
    assert set(clean) == set(single)
    for d, r in clean.items():
        assert r.n_chars == len(r.text)
        if not base_spans(single[d].text):
            assert r.text == single[d].text
        assert not base_spans(r.text) and not re.search(r"@mail\d+\.example", r.text)


def test_mix_and_encoding(steps):
    before, mixed = steps["personal_data"].collect(), steps["mixing"].collect()
    text_of = {r.doc_id: r.text for r in before}
    words = re.compile(r"[^\x20\x09-\x0D]+")
    cut = [r for r in mixed if r.text != text_of[r.doc_id]]
    assert all(text_of[r.doc_id].startswith(r.text) for r in cut) and len(cut) <= len({r.source for r in before})
    total = sum(len(words.findall(r.text)) for r in mixed)
    assert abs(total - sum(len(words.findall(t)) for t in text_of.values())) <= len({r.source for r in before})
    library, encoded = Tokenizer.from_file(vocabulary_path()), steps["encoding"].collect()
    want = sorted((r.doc_id, library.encode(r.text, add_special_tokens=False).ids) for r in mixed)
    assert sorted((r.doc_id, list(r.ids)) for r in encoded) == want
    assert all(r.decoded == library.decode(list(r.ids), skip_special_tokens=False) and r.n_tokens == len(r.ids) for r in encoded)


def test_odd_rows(spark, sf, odd, none):
    for start in (odd, none):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = checkpointed(stage(spark, docs, sf))
        assert {"doc_id", "ids", "decoded"} <= set(docs.columns)
    assert docs.count() == 0
