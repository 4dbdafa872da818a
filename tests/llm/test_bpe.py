import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanery.llm.bpe import Encoder, Vocabulary, decode_text, encode_ids, round_trip
from gleanery.llm.queries import QUERIES, vocabulary_path

TEXTS = [
    "", " ", "<|endoftext|>x<|startoftext|>", "Hello <|endoftext|> World's don't I'LL '", "a" * 5000, "ab" * 3000 + "c",
    "ΑΣ ΣΑΣ Σ", "İstanbul ǅ ﬁ é Å", "a\x1cb\x85c\xa0d​e",
    "日本語 テスト \U0001f642\U0001f642", "1234 ٣٤ \xbd \xb2", "$'s 's''s", "ẞ ŉ",
    "\x00\x01 \x1f a", "﻿a b　c", "aaa aaaa aaaaa lolol", "x" * 10000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def test_merges_are_those_of_the_library(library):
    draw = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz' .,!?-0123456789éßñè"
    texts = TEXTS + ["".join(draw.choice(letters) for _ in range(200)) for _ in range(200)]
    vocabulary = Vocabulary(vocabulary_path())
    for encoder in (Encoder(vocabulary), Encoder(vocabulary)):
        for ids, want in zip(encoder.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
            assert ids.tolist() == want.ids
            assert vocabulary.decode(ids) == library.decode(want.ids, skip_special_tokens=False)


def test_leftmost_merges_one_at_a_time_give_the_same():
    vocabulary, words = Vocabulary(vocabulary_path()), [b"aaaa", b"lololol", b"unbelievably", b"x"]
    at_once = vocabulary.merge(words)
    assert vocabulary.all_at_once
    vocabulary.all_at_once = False
    single = vocabulary.merge(words)
    assert at_once[0].tolist() == single[0].tolist() and at_once[1].tolist() == single[1].tolist()


def test_full_cache_is_emptied(monkeypatch, library):
    monkeypatch.setattr("gleanery.llm.bpe._CACHED_WORDS", 3)
    encoder = Encoder(Vocabulary(vocabulary_path()))
    for text in ["one two three four five", "six one seven", "two two eight"]:
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_query(spark, sf, documents, library):
    got = {r.doc_id: r for r in QUERIES["op10_bpe"](spark, sf).collect()}
    for r in documents.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(odd, none, library):
    path = vocabulary_path()
    both = round_trip(odd.withColumn("IDS", F.lit(1)), path).select("doc_id", "text", "ids", "decoded").collect()
    apart = decode_text(encode_ids(odd, path), path).select("doc_id", "text", "ids", "decoded").collect()
    assert sorted(map(repr, both)) == sorted(map(repr, apart)) and len(both) == odd.count()
    for r in both:
        assert list(r.ids) == library.encode(r.text or "", add_special_tokens=False).ids
    assert round_trip(none, path).collect() == [] and encode_ids(none, path, packed=True).collect() == []
    assert decode_text(odd.select(F.lit(None).cast("array<int>").alias("ids")), path).first().decoded is None
