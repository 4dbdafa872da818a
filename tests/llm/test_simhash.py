import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gleanery.llm.bktree import build, pairs_within
from gleanery.llm.queries import QUERIES
from gleanery.llm.simhash import keep_one, shard_links, simhash, simhash_groups


def plain_simhash(text):
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = [w for w in (text or "").translate(str.maketrans(upper, lower)).replace("\t", " ").replace("\n", " ")
             .replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fingerprints):
    """Smallest id of each id's group, by comparing all pairs."""
    root = {d: d for d in fingerprints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(fingerprints)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (fingerprints[a] ^ fingerprints[b]).bit_count() <= 3:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: find(d) for d in ids}


@pytest.mark.parametrize("text", [None, "", " \n", "one", "One two", "a b c", "Éa BÜ c d", "x " * 70000, "a\x1cb c\x85d e"])
def test_fingerprint(text):
    assert simhash(text) == plain_simhash(text)


def test_query_against_all_pairs(spark, sf, documents):
    got = {r.doc_id: r for r in QUERIES["op3_simhash"](spark, sf).collect()}
    want = {r.doc_id: plain_simhash(r.text) for r in documents.collect()}
    assert {d: r.fingerprint for d, r in got.items()} == {d: f"{f:016x}" for d, f in want.items()}
    assert {d: r.component_id for d, r in got.items()} == plain_groups(want)


def test_tree_follows_all_edges_it_needs():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2 ** 63, 80, dtype=np.int64).astype(np.uint64)
    values = np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 80).astype(np.uint64)) for _ in range(4)])
    tree = np.sort(rng.integers(0, 3, len(values)))
    found = {p for a, b in pairs_within(values, tree, 3, block=64) for p in zip(a.tolist(), b.tolist())}
    want = {(i, j) for i in range(len(values)) for j in range(i)
            if tree[i] == tree[j] and (int(values[i]) ^ int(values[j])).bit_count() <= 3}
    assert found == want
    parent, edge = build(values, tree)
    inner = np.flatnonzero(parent >= 0)
    assert all((int(values[i]) ^ int(values[parent[i]])).bit_count() == edge[i] for i in inner)
    children = {(p, e) for p, e in zip(parent[inner], edge[inner])}
    assert len(children) == len(inner)  # one child for each distance


@pytest.mark.parametrize("shard", [64, 512])
def test_hot_shards_are_split_without_losing_links(spark, shard):
    """Many fingerprints that agree in most bits, in shards far over the limit."""
    draw = random.Random(2)
    values = {0}
    while len(values) < 300:
        values.add(sum(1 << b for b in draw.sample(range(20), draw.randrange(1, 9))))
    far = {draw.getrandbits(63) for _ in range(50)}
    fps = spark.createDataFrame([(v,) for v in sorted(values | far)], "fp bigint")
    edges = shard_links(fps, shard=shard).collect()
    assert all((e.a ^ e.b).bit_count() for e in edges)
    group = plain_groups({v: v for v in values | far})
    root = {v: v for v in group}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for e in edges:
        low, high = sorted((find(e.a), find(e.b)))
        root[high] = low
    assert {v: find(v) for v in group} == group


def test_odd_rows(odd, none):
    groups = simhash_groups(odd.withColumn("Component_Id", F.lit(0)))
    rows = groups.collect()
    assert len(rows) == odd.count()
    zero = [r for r in rows if r.fingerprint == 0]
    assert {r.component_id for r in zero} == {1} and len(zero) == 4  # null, empty, blank and the row of nulls
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    kept = keep_one(groups).select(*odd.columns)
    assert kept.count() == len({r.group_fp for r in rows})
    assert simhash_groups(none).collect() == [] and keep_one(simhash_groups(none)).collect() == []
