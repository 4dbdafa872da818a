import random
from collections import defaultdict

import pyarrow as pa
import pytest

import corpus_pipeline
from gleanery.llm import nearcopies, simhash
from gleanery.llm.nearcopies import bands, jaccard, near_copy_groups, shingles


def plain_groups(texts):
    """Smallest id of each id's group, by comparing all pairs that share a shingle, as sets of strings."""
    def split(t):
        words = [w.decode() for w in (t or "").encode().lower().split()]
        return {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets, root, holds = {d: split(t) for d, t in texts.items()}, {d: d for d in texts}, defaultdict(list)

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for d in sorted(texts):
        for other in {o for s in sets[d] for o in holds[s]}:
            if len(sets[d] & sets[other]) >= 0.8 * len(sets[d] | sets[other]):
                low, high = sorted((find(d), find(other)))
                root[high] = low
        for s in sets[d]:
            holds[s].append(d)
    return {d: find(d) for d in texts}


def test_stage_keeps_one_of_each_group_of_brute_force(spark):
    """Most pairs at 0.8 differ in more than three bits of their SimHash."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("text rlike '[a-z]'")
    groups = plain_groups({r.doc_id: r.text for r in docs.collect()})
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(groups.values())


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_group_without_a_centre(spark, monkeypatch, broadcast):
    """Chains of near copies and a common passage, in buckets of several chunks; ids of rows sent around, and joined."""
    monkeypatch.setattr(nearcopies, "_CHUNK", 8)
    monkeypatch.setattr(nearcopies, "BROADCAST", broadcast)
    draw = random.Random(3)
    words, texts = [f"w{i}" for i in range(150)], {}
    for i in range(60):  # each step changes one word of the last
        words[draw.randrange(150)] = f"x{i}"
        texts[i] = " ".join(words)
    passage = " ".join(f"p{i}" for i in range(100))
    for i in range(60, 100):
        texts[i] = passage + " " + " ".join(f"q{i}.{j}" for j in range(draw.randrange(5, 40)))
    rows = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_copy_groups(rows).collect()}
    assert got == plain_groups(texts) and len(set(got.values())) > 2


def test_odd_rows(odd, none):
    rows = near_copy_groups(odd).collect()
    assert len(rows) == odd.count() and {r.component_id for r in rows if not (r.text or "").strip()} == {1}
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    assert near_copy_groups(none).collect() == []
    assert len(nearcopies._alike().func(pa.array([], pa.binary()), pa.array([], pa.binary()))) == 0
    assert jaccard(shingles("A b"), shingles("a  B")) == 1 and len(shingles("a b c d e f")) == 2


def test_stage_compares_what_the_bk_trees_of_simhash_link(spark, monkeypatch):
    """Without MinHash bands the linked fingerprints alone tie copies with a changed word together; unlike texts they never join."""
    draw = random.Random(7)
    base = [f"w{draw.randrange(3000)}" for _ in range(2000)]
    texts = {0: " ".join(base), 1: " ".join([*base[:1999], "other"]), 2: " ".join(["first", *base[1:]])}
    texts |= {10 + i: " ".join(f"v{draw.randrange(3000)}" for _ in range(2000)) for i in range(4)} | {20: "a b", 21: "c d"}
    folds = {d: simhash.fold_bits(shingles(t)) for d, t in texts.items()}
    assert max((folds[0] ^ folds[d]).bit_count() for d in (1, 2)) <= 3 and simhash.fold_bits(shingles("")) == 0
    linked = []
    monkeypatch.setattr(nearcopies, "shard_links", lambda fps: linked.append(fps.count()) or simhash.shard_links(fps))
    monkeypatch.setattr(nearcopies, "bands", lambda found: ([], bands(found)[1]))
    rows = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, rows, "")
    assert linked == [len(set(folds.values()))]
    assert {r.doc_id for r in kept.collect()} == set(plain_groups(texts).values())


def near_limit(draw, copies, length, *changes):
    """Copies of one text with some words changed in each, so that most pairs are 0.3 to 0.8 alike."""
    base = [f"b{draw.random()}" for _ in range(length)]
    for _ in range(copies):
        words = list(base)
        for _ in range(draw.randrange(*changes)):
            words[draw.randrange(length)] = f"c{draw.randrange(9)}" if draw.random() < 0.3 else f"d{draw.random()}"
        yield " ".join(words)


def test_large_buckets_do_not_meet_in_all_pairs(spark, monkeypatch):
    """Texts around one base, and texts with a common passage: no link is lost; 58,593 pairs were compared when all of a bucket met."""
    draw, compared = random.Random(11), []
    texts = [*near_limit(draw, 350, 150, 2, 9), *(" ".join(f"p{j}" for j in range(60)) + f" q{i} " + " ".join(f"q{i}.{j}" for j in range(i % 90)) for i in range(250))]
    likely = nearcopies._likely
    monkeypatch.setattr(nearcopies, "_likely", lambda pairs, classes: compared.append(pairs.select("a", "b").distinct().count()) or likely(pairs, classes))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_copy_groups(rows).collect()}
    assert got == plain_groups(dict(enumerate(texts))) and 100 < len(set(got.values())) < 550
    assert compared[-1] < 20_000


@pytest.mark.parametrize("chunk", [1, 6])
def test_every_link_of_crowds(spark, monkeypatch, chunk):
    """Several bases of unlike lengths, shared changes, repeats and parts cut off, in buckets that all count as large."""
    monkeypatch.setattr(nearcopies, "_CHUNK", chunk)
    draw, texts = random.Random(chunk), []
    for length in (12, 60, 200):
        for t in near_limit(draw, 40, length, 0, 1 + length // 10):
            words = t.split()
            texts.append(" ".join(words[:draw.randrange(length * 3 // 4, length + 1)]))
    texts += texts[::7]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_copy_groups(rows).collect()}
    assert got == plain_groups(dict(enumerate(texts))) and len(set(got.values())) > 10
