import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import hardnegatives
from gleanery.llm.hardnegatives import LOWEST, HIGHEST, _interval, _str_order, _Tree, build_index, mine

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, every=5, positives=5, negatives=3):
    """All pairs, in whole numbers."""
    used = []
    for i, v, label in rows:
        if i is None or label is None or not v or None in v or not np.isfinite(np.array(v, float)).all():
            continue
        used.append((i, label, tuple(int(c) for c in np.floor(256 * np.array(v, np.float32).astype(float)))))
    used, out = sorted(set(used)), []
    score = lambda a, b: sum(p * q for p, q in zip(a[2], b[2]))
    for a in used:
        if a[0] % every:
            continue
        others = sorted(((-score(a, b), b[0], b[1]) for b in used if b[0] != a[0] and len(b[2]) == len(a[2])))
        for s, p, _ in [o for o in others if o[2] == a[1]][:positives]:
            fit = [o for o in others if o[2] != a[1] and 50 * -s <= 100 * -o[0] <= 95 * -s][:negatives]
            out += [(a[0], p, r + 1, o[1], -s, -o[0]) for r, o in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, every=5, **options):
    data = [(i, None if v is None else [None if c is None else float(c) for c in v], label) for i, v, label in rows]
    found = mine(spark.createDataFrame(data, SCHEMA), F.col("vec_id") % every == 0, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("shape", [{}, {"shard": 24, "sample": 100}])
def test_against_all_pairs(spark, shape, monkeypatch):
    """Clusters, copies over labels, ties; one tree, and many shards whose tiles are laid out by a part of the rows."""
    monkeypatch.setattr(hardnegatives, "LEAF", 4)
    monkeypatch.setattr(hardnegatives, "PER_TILE", 8)
    monkeypatch.setattr(hardnegatives, "BOXES", 3)
    monkeypatch.setattr(hardnegatives, "REQUESTS", 7)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + 0.5 * rng.normal(size=12)).tolist(), int(rng.integers(0, 4))) for i in range(240)]
    rows += [(1000 + i, rows[3][1], i % 2) for i in range(120)]  # a third of all rows
    rows += [(2000 + i, np.rint(rng.normal(size=12)).tolist(), i % 3) for i in range(60)]
    want = plain(rows)
    assert mined(spark, rows, **shape) == want and len(want) > 400


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 0), (0, [1.0, 0.5], 0), (0, [0.5, 1.0], 0), (None, [1.0, 1.0], 1), (5, None, 0), (5, [], 0), (5, [nan, 1], 0),
        (5, [inf, 1], 1), (5, [None, 1], 1), (10, [1.0, 1.0], None), (1, [1.0, 1.0], 0), (2, [0.5, 0.5], 1), (2, [0.6, 0.5], 1),
        (3, [0.5, 0.5], 1), (4, [0, 0], 2), (15, [0, 0], 2), (16, [0, 0], 2), (17, [0, 0], 1), (20, [1.0, 2.0, 3.0], 1),
        (21, [1.0, 2.0, 3.0], 1), (22, [0.9, 1.5, 2.0], 0), (25, [-1.0, 0], 3), (26, [1.0, 0], 3),
    ]
    want = plain(rows)
    assert mined(spark, rows) == want and {r[0] for r in want} >= {0, 15, 20} and 25 not in {r[0] for r in want}
    frame = spark.createDataFrame([(0, [1.0], 0), (1, [1.0], 0), (2, [0.9], 1)], SCHEMA)
    clashing = frame.withColumns({"score": F.lit(1), "x": F.lit(2), "anchor": F.lit(3), "rank": F.lit(4)})
    assert [tuple(r)[:4] for r in mine(clashing, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2)]
    assert mined(spark, []) == [] and mine(frame, F.lit(None).cast("boolean")).collect() == []
    with pytest.raises(ValueError):
        mined(spark, [(0, [1.0] * 5000, 0)])


def test_boxes_bound_products_and_the_queue_prunes(monkeypatch):
    monkeypatch.setattr(hardnegatives, "LEAF", 8)
    rng = np.random.default_rng(2)
    centres = rng.integers(-500, 500, (40, 6))
    x = (centres[rng.integers(0, 40, 4000)] + rng.integers(-20, 20, (4000, 6))).astype(np.int64)
    label = rng.integers(0, 3, 4000)
    order = _str_order(label, x, 8)
    assert sorted(order) == list(range(4000))
    tree = _Tree(label[order], x[order], [[int(i)] for i in order])
    assert len(tree.levels[0][0]) == 500 and len(tree.levels[-1][0]) == 1
    query = centres[3] + 1
    least, most = _interval(query[None], *tree.levels[0][:2])
    scores = (tree.x @ query).reshape(500, 8)
    assert (least[0] <= scores.min(1)).all() and (scores.max(1) <= most[0]).all()
    seen = []
    monkeypatch.setattr(hardnegatives, "_dot", lambda a, b: seen.append(len(b)) or a @ b.T)
    lows, highs = np.array([LOWEST]), np.array([HIGHEST])
    (found,) = tree.search(query, 1, -1, False, lows, highs, lows, 5)
    everything = sorted((-int(s), int(i)) for i, s, c in zip(order, tree.x @ query, label[order]) if c != 1)
    assert found == everything[:5]
    assert seen.count(1) < 100  # leaves looked into, of 500


def test_all_vectors_are_placed(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i % 2), rng.integers(-9, 9, 4).tolist(), [i]) for i in range(500)] + [(0, [1, 1, 1, 1], [i]) for i in range(500, 600)]
    classes = spark.createDataFrame(rows, "label bigint, x array<bigint>, ids array<bigint>")
    shards, boxes = build_index(classes, sample=100, shard=40)
    trees = [hardnegatives._unpacked(bytes(r.tree)) for r in shards.collect()]
    assert sorted(i for t in trees for (i,) in t.column("ids").to_pylist()) == list(range(600))
    assert boxes.count() == len(trees) > 10


def test_requests_of_a_block_share_the_boxes_they_open(monkeypatch):
    """Many requests with windows of their own get what each gets alone; a leaf is read once for all of them."""
    monkeypatch.setattr(hardnegatives, "LEAF", 8)
    rng = np.random.default_rng(5)
    x, label = rng.integers(-300, 300, (1600, 24)), rng.integers(0, 4, 1600)
    order = _str_order(label, x, 8)
    tree = _Tree(label[order], x[order], [[int(i), int(i) % 7] for i in order])
    asked = rng.integers(-300, 300, (40, 24))
    labels, owns = rng.integers(0, 4, 40), list(range(40))
    bounds = [np.sort(rng.integers(-400_000, 900_000, (2, i % 4))) for i in range(40)]
    lows, highs = [np.minimum(*b) for b in bounds], [np.maximum(*b) for b in bounds]
    floors = [np.full(len(v), LOWEST) for v in lows]
    for same in (True, False):
        seen = []
        with monkeypatch.context() as m:
            m.setattr(hardnegatives, "_dot", lambda a, b: seen.append(len(a)) or a @ b.T)
            got = tree.search_many(asked, labels, owns, same, lows, highs, floors, 3)
        assert seen.count(8) <= 200
        for i in range(40):
            scores, fits = tree.x @ asked[i], (tree.label == labels[i]) == same
            for w in range(len(lows[i])):
                inside = np.flatnonzero(fits & (scores >= lows[i][w]) & (scores <= highs[i][w]))
                want = sorted((-int(scores[j]), v) for j in inside for v in tree.ids[j] if v != owns[i])[:3]
                assert got[i][w] == want
            assert got[i][:len(lows[i])] == tree.search(asked[i], labels[i], owns[i], same, lows[i], highs[i], floors[i], 3)
