import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm.embeddings import _STEPS, decode, embedding_groups


def plain(rows, least=0.98):
    """(id, links, component) by comparing all pairs."""
    use = [v is not None and len(v) > 0 and label is not None and i is not None and None not in v
           and bool(np.isfinite(v).all()) and bool(np.any(v)) for i, v, label in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if u else None for (_, v, _), u in zip(rows, use)]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if use[i] and use[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and (
                    rows[i][1] == rows[j][1] or unit[i] @ unit[j] >= least):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                if a != b:
                    low, high = sorted((a, b), key=lambda k: rows[k][0])
                    root[high] = low
    return sorted((r[0], n, rows[find(i)][0]) for i, (r, n) in enumerate(zip(rows, links)))


def test_lattice_points_are_the_nearest():
    x = np.random.default_rng(0).normal(size=(300, 8)) * 2
    points = decode(x)
    assert len(_STEPS) == 241
    whole = np.allclose(points * 2, np.rint(points * 2))
    assert whole and (np.rint(points.sum(1)) % 2 == 0).all()
    far = ((x[:, None] - points[:, None] - _STEPS[None]) ** 2).sum(2)
    assert (far.argmin(1) == 0).all()


@pytest.mark.parametrize("chunk", [512, 8])
def test_against_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr("gleanery.llm.embeddings._CHUNK", chunk)
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for size, noise in ((1, 0), (30, 0.01), (60, 0.022), (40, 0.0), (3, 0.02)) * 2 + ((1, 0),) * 60:
        center = rng.normal(size=64)
        for _ in range(size):
            v = center + noise * rng.normal(size=64) * np.linalg.norm(center) / 1.4
            rows.append((i, [float(x) for x in np.float32(v)], i % 2 if size == 1 else 0))
            i += 1
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_groups(docs).collect())
    want = plain(rows)
    assert got == want and sum(n for _, n, _ in want) > 1000


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, nan], 0), (5, [inf, 1.0], 0), (6, [1.0, None], 0),
        (7, [1.0, 0.0], None), (8, [1.0, 0.0], 0), (9, [2.0, 0.0], 0), (10, [1.0, 0.0], 0), (10, [1.0, 0.0], 0), (11, [1.0, 0.0, 0.0], 0),
        (12, [1.0, 0.0], 1), (13, [-1.0, 0.0], 0), (8, [1.0, 0.01], 1),
    ]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    found = embedding_groups(docs.withColumn("KEPT", F.lit(1))).collect()
    assert len(found) == len(rows)
    by_id = {(r.vec_id, r.label): (r.n_links, r.component_id, r.kept) for r in found}
    for i in (1, 2, 3, 4, 5, 6, 11, 13):
        assert by_id[i, 0] == (0, i, True)
    assert by_id[7, None] == (0, 7, True)
    assert by_id[9, 0] == (3, 8, False) and by_id[10, 0] == (3, 8, False)
    assert by_id[12, 1][1] == 8
    assert embedding_groups(docs.limit(0)).collect() == []
    nameless = embedding_groups(spark.createDataFrame([(None, [1.0, 0.0], 0)], docs.schema)).first()
    assert (nameless.n_links, nameless.component_id, nameless.kept) == (0, None, False)
