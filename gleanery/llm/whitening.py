"""Whitening of embeddings by Chebyshev-filtered subspace iteration over distributed products."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import without

SCALE, SHIFT = 64, 1_000_000  # entries become floor(64 c) + 1,000,000
COMPONENTS = 16
SPARE = 16  # columns of the block beside the wanted ones
DEGREES = (4, 32)  # least and largest degree of a filter
GAIN = 1e5  # by which a filter is to lift the last wanted direction above the damped ones
TOLERANCE = 2e-14  # certified: residuals of all wanted pairs, over the largest eigenvalue
STALLED = 1e-11  # where rounding stops the residuals from falling, they must be below this
ROUNDS = 60
MERGERS = 16  # tasks that add up the partial products of all others
_LIMIT = float(2 ** 52)
_SEED = 11
_ADDED = ("deviation", "whitened")


@dataclass(frozen=True)
class Model:
    """A fit: n distinct vectors with sums S, unit directions by falling eigenvalue, and what certifies them."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues e of the covariance
    directions: np.ndarray  # a column for each
    trace: float
    residual: float  # largest residual over the largest eigenvalue
    identity_error: float
    passes: int

    @property
    def explained(self) -> list[float]:
        return [float(e) / self.trace for e in self.values]


def usable(embedding: str) -> Column:
    """Not null, not empty, all entries finite and small enough to be counted in whole steps."""
    bad = F.exists(embedding, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) * SCALE >= _LIMIT))
    return F.coalesce((F.size(embedding) > 0) & ~bad, F.lit(False))


def steps(embedding: str) -> Column:
    """Entries in whole steps, as BIGINT."""
    return F.transform(embedding, lambda v: F.floor(v.cast("double") * SCALE).cast("bigint") + SHIFT)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


class _Centre:
    """x - S / n without loss: the whole part of the mean is taken off in integers, then the fraction."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]
        self.fraction = np.array([r / n for r in self.rest])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.fraction

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n x - S)^2, exact; None where that is beyond 64 bits."""
        off = x - self.whole
        most = float(np.abs(off).max(initial=0) + 1) * self.n
        if most * most * x.shape[1] < 2.0 ** 62:
            moved = off * self.n - np.array(self.rest, np.int64)
            return (moved * moved).sum(1).tolist()
        moved = off.astype(object) * self.n - np.array(self.rest, object)
        return [v if v < 2 ** 63 else None for v in (moved * moved).sum(1).tolist()]


def _summed(fit: DataFrame, shape: tuple[int, int], part) -> np.ndarray:
    """Sum over all vectors of part(x), a matrix of that shape, for batches x of a task.

    Each task adds up its own batches and hands on one matrix; a few tasks add up those, so the
    driver gets MERGERS matrices however many tasks there were.
    """
    dimensions = shape[0]

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += part(_matrix(batch.column(0), dimensions))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(shape), False
        for batch in batches:
            for m in batch.column(0):
                total += np.frombuffer(m.as_py()).reshape(shape)
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    parts = fit.select("x").mapInArrow(own, "m binary").repartition(MERGERS).mapInArrow(merged, "m binary")
    return sum((np.frombuffer(r.m).reshape(shape) for r in parts.collect()), np.zeros(shape))


class _Covariance:
    """V Q for the covariance V of the fit list, one pass over it a product; V itself is never formed."""

    def __init__(self, fit: DataFrame, centre: _Centre):
        self.fit, self.centre, self.passes = fit, centre, 0

    def times(self, q: np.ndarray) -> np.ndarray:
        centre = self.centre

        def part(x: np.ndarray) -> np.ndarray:
            c = centre(x)
            return c.T @ (c @ q)

        self.passes += 1
        return _summed(self.fit, q.shape, part) / centre.n

    def trace(self, dimensions: int) -> float:
        centre = self.centre
        self.passes += 1
        squares = _summed(self.fit, (dimensions, 1), lambda x: (centre(x) ** 2).sum(0)[:, None])
        return float(squares.sum()) / centre.n

    def moments(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean of the vectors times w, and their covariance, centred by that mean before multiplying."""
        centre, (dimensions, k) = self.centre, w.shape
        self.passes += 2

        def place(small: np.ndarray) -> np.ndarray:
            out = np.zeros((dimensions, k))
            out[: len(small)] = small
            return out

        mean = _summed(self.fit, (dimensions, k), lambda x: place((centre(x) @ w).sum(0)[None, :]))[0] / centre.n

        def part(x: np.ndarray) -> np.ndarray:
            z = centre(x) @ w - mean
            return place(z.T @ z)

        return mean, _summed(self.fit, (dimensions, k), part)[:k] / centre.n


def _degree(lift: float) -> int:
    """Degree at which a Chebyshev polynomial reaches GAIN at `lift`, where 1 is the end of what it damps."""
    return int(min(max(math.acosh(GAIN) / math.acosh(max(lift, 1 + 1e-9)), DEGREES[0]), DEGREES[1]))


def _filtered(v: _Covariance, q: np.ndarray, cut: float, degree: int, top: float) -> np.ndarray:
    """T(V) Q for the Chebyshev polynomial T that stays within 1 on [0, cut] and grows fast above.

    Scaled by its value at `top` as it goes, so that it cannot overflow.
    """
    half = cut / 2
    sigma = first = half / (top - half)
    before, now = q, (v.times(q) - half * q) * (first / half)
    for _ in range(2, degree + 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (v.times(now) - half * now) * (2 * following / half) - (sigma * following) * before
        sigma = following
    return now


def _eigen(v: _Covariance, dimensions: int, wanted: int, spare: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest eigenvalues, their directions and the largest residual over the first eigenvalue.

    Rounds of filter, QR and Rayleigh-Ritz. What is to be damped is [0, cut], cut being the least
    Ritz value of the block; where rounds gain little it is lowered, as then the least Ritz value
    belongs to the wanted ones' own cluster.
    """
    rng = np.random.default_rng(_SEED)
    q = np.linalg.qr(rng.normal(size=(dimensions, min(dimensions, wanted + spare))))[0]
    lowered, last, best = 1.0, math.inf, None
    for _ in range(ROUNDS):
        vq = v.times(q)
        ritz = q.T @ vq
        values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = values[0]
        if top <= 0:
            return values[:0], q[:, :0], 0.0
        residual = float(np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max() / top)
        if best is None or residual < best[2]:
            best = values[:wanted], q[:, :wanted], residual
        if residual <= TOLERANCE or (best[2] <= STALLED and residual > last / 2):
            return best
        if residual > last / 10:
            lowered = max(lowered * 0.8, 0.1)
        last = residual
        cut = max(values[-1] * lowered, top * 1e-12)
        lift = 2 * max(values[min(wanted, len(values)) - 1], cut) / cut - 1
        q = np.linalg.qr(_filtered(v, q, cut, _degree(lift), top))[0]
    raise RuntimeError(f"no certified directions after {ROUNDS} rounds: residual {best[2]:.1e}")


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """n and the exact sum of each dimension."""
    n = fit.count()
    places = fit.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("s"))
    return n, [int(r.s) for r in places.orderBy("i").collect()]


def train(vectors: DataFrame, embedding: str = "embedding", components: int = COMPONENTS, spare: int = SPARE) -> dict[int, Model]:
    """A model for each length of vector that occurs (fitted apart), from all usable vectors.

    Every distinct vector of whole steps counts once. Copies are merged by the map tasks before
    anything is shuffled; the list is written, and each product with the covariance is one pass
    over it that returns a matrix of dimensions x (components + spare). Directions without
    variance (eigenvalues below 1e-12 of the first) are left out, as they cannot be whitened.
    """
    fit = checkpointed(vectors.filter(usable(embedding)).select(steps(embedding).alias("x")).distinct())
    models = {}
    for d in sorted(r.d for r in fit.select(F.size("x").alias("d")).distinct().collect()):
        mine = fit.filter(F.size("x") == d)
        n, sums = _sums(mine)
        v = _Covariance(mine, _Centre(n, sums))
        trace = v.trace(d)
        values, directions, residual = _eigen(v, d, min(components, d), spare) if trace > 0 else (np.empty(0), np.empty((d, 0)), 0.0)
        some = values > 1e-12 * (values[0] if len(values) else 0)
        values, directions = values[some], directions[:, some]
        error = 0.0
        if len(values):
            _, covariance = v.moments(directions / np.sqrt(values))
            error = float(np.abs(covariance - np.eye(len(values))).max())
        models[d] = Model(n, sums, values, directions, trace, residual, error, v.passes)
    return models


def whiten(vectors: DataFrame, models: dict[int, Model], embedding: str = "embedding") -> DataFrame:
    """The usable rows of vectors, with deviation BIGINT and whitened ARRAY<DOUBLE>.

    whitened has the row's projections on the directions of its length, each over the root of its
    eigenvalue. Vectors that are null or empty or hold nulls, non-finite entries or entries of
    2^46 or more are dropped; zero vectors stay. Repeated rows and rows without an id stay as they
    are. deviation is null where it is beyond 64 bits. Vectors whose length was not in the fit have
    neither. Empty input gives no rows. Columns of vectors with the names of the added ones are
    replaced.
    """
    ready = {d: (_Centre(m.n, m.sums), m.directions / np.sqrt(m.values)) for d, m in models.items()}

    @F.arrow_udf("struct<deviation bigint, whitened array<double>>")
    def transformed(lists: pa.Array) -> pa.Array:
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        far: list = [None] * len(lists)
        white: list = [None] * len(lists)
        for d in np.unique(sizes).tolist():
            if d not in ready:
                continue
            rows = np.flatnonzero(sizes == d)
            x = flat[starts[rows][:, None] + np.arange(d)]
            centre, w = ready[d]
            z = centre(x) @ w
            for i, deviation, row in zip(rows.tolist(), centre.deviation(x), z):
                far[i], white[i] = deviation, row
        return pa.StructArray.from_arrays(
            [pa.array(far, pa.int64()), pa.array(white, pa.list_(pa.float64()))], ["deviation", "whitened"]
        )

    kept = without(vectors, _ADDED).filter(usable(embedding))
    return (
        kept.withColumn("_whitening", transformed(steps(embedding)))
        .withColumns({"deviation": F.col("_whitening.deviation"), "whitened": F.col("_whitening.whitened")})
        .drop("_whitening")
    )
