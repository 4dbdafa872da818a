import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery import llm
from gleanery.llm import whitening
from gleanery.llm.whitening import _Centre, train, whiten


def frame(spark, vectors, ids=None):
    rows = list(zip(ids or range(len(vectors)), [None if v is None else [None if e is None else float(e) for e in v] for v in vectors]))
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def plain(vectors, components=16):
    """n, sums, eigenvalues and directions from the covariance itself."""
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), [int(s) for s in fit.sum(0)]
    c = np.array([[int(v) * n - s for v, s in zip(row, sums)] for row in fit], float) / n
    values, directions = np.linalg.eigh(c.T @ c / n)
    return x, n, sums, values[::-1][:components], directions[:, ::-1][:, :components], values.sum()


def test_query_against_the_whole_covariance(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    x, n, sums, values, directions, trace = plain([v.embedding for v in vectors])
    rows = llm.all_queries()["op11_whitening"](spark, sf).collect()
    assert len(rows) == len(vectors) * 16 and {r.n for r in rows} == {n}
    by = {(r.vec_id, r.component): r for r in rows}
    for j in range(16):
        got = np.array([by[v.vec_id, j + 1].whitened for v in vectors])
        want = (x - np.array(sums) / n) @ directions[:, j] / np.sqrt(values[j])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8
        assert abs(by[0, j + 1].explained / (values[j] / trace) - 1) < 1e-10
    for v, row in zip(vectors, x):
        assert by[v.vec_id, 1].deviation == sum((n * int(a) - s) ** 2 for a, s in zip(row, sums))
    assert max(r.identity_error for r in rows) < 1e-10


@pytest.mark.parametrize("shape", ["decaying", "flat above a step", "few dimensions", "rank three"])
def test_spectra(spark, shape):
    rng = np.random.default_rng(5)
    d = 5 if shape == "few dimensions" else 40
    if shape == "decaying":
        v = rng.normal(size=(400, d)) * 20 * 0.7 ** np.arange(d)
    elif shape == "flat above a step":  # 36 equal eigenvalues, more than the block holds, and four lower ones
        v = np.concatenate([np.eye(d), -np.eye(d)]) * np.where(np.arange(d) < 36, 40, 20)
    elif shape == "rank three":
        v = np.rint(rng.normal(size=(300, 3)) * 9) @ np.rint(rng.normal(size=(3, d)) * 3)
    else:
        v = rng.normal(size=(60, d)) * 9
    model = train(frame(spark, v.tolist()))[d]
    _, n, _, values, _, trace = plain(v)
    some = values[: 3 if shape == "rank three" else 16]
    assert model.n == n and len(model.values) == len(some) and np.allclose(model.values, some, rtol=1e-10)
    assert model.identity_error < 1e-9 and np.allclose(model.directions.T @ model.directions, np.eye(len(some)), atol=1e-12)
    assert abs(model.trace / trace - 1) < 1e-9


def test_copies_count_once_and_all_rows_return(spark):
    rng = np.random.default_rng(6)
    base = (rng.normal(size=(50, 6)) * 4).tolist()
    vectors = base + [base[0]] * 100 + [[e + 1e-6 for e in base[1]]]
    model = train(frame(spark, vectors))[6]
    once = train(frame(spark, base))[6]
    assert model.n == plain(vectors)[1] and model.n < 53 and abs(model.n - once.n) <= 1
    assert whiten(frame(spark, vectors), {6: model}).count() == 151


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [1, None], [nan, 1], [1, -inf], [1e30, 0], [0, 0], [1, 2], [3, -1], [3, -1], [2, 2], [1, 2, 3], [1, 2, 4], [5]]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, None, None, 10, 11, 12, 13]
    rows = frame(spark, vectors, ids).withColumn("WHITENED", F.lit(1)).withColumn("n", F.lit(2))
    models = train(rows)
    assert {d: (m.n, len(m.values)) for d, m in models.items()} == {1: (1, 0), 2: (4, 2), 3: (2, 1)}
    got = whiten(rows, models).collect()
    assert sorted((r.vec_id or 0, len(r.whitened)) for r in got) == [(0, 2), (0, 2), (7, 2), (8, 2), (10, 2), (11, 1), (12, 1), (13, 0)]
    assert all(r.n == 2 for r in got) and {r.deviation for r in got if r.vec_id == 13} == {0}
    none = rows.limit(0)
    assert train(none) == {} and whiten(none, {}).collect() == []


def test_deviation_is_exact_and_null_beyond_64_bits():
    x = np.array([[1_000_003, 999_990], [1_000_000, 1_000_000]], np.int64)
    for n in (7, 10 ** 7, 10 ** 12):
        sums = [1_000_000 * n + 5, 1_000_000 * n - 3]
        want = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
        assert _Centre(n, sums).deviation(x) == [w if w < 2 ** 63 else None for w in want]


def test_uncertified_directions_are_refused(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROUNDS", 1)
    rng = np.random.default_rng(7)
    with pytest.raises(RuntimeError, match="certified"):
        train(frame(spark, (rng.normal(size=(200, 40)) * 5).tolist()))
