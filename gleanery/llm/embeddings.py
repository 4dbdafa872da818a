"""Near-duplicate embeddings by lattice hashing: cells of E8, neighbouring cells, exact cosines."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import without
from .components import components

TABLES = 4  # random projections
PROBES = 16  # cells looked up in each table: the 16 nearest of a point's own and its 240 neighbours
SCALE = 1.0  # spread of the projected points, in units of the lattice
_CHUNK = 512  # members of a cell that are compared at a time
_SEED = 20
_ADDED = ("n_links", "component_id", "kept")


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of +-1, or eight halves with an even number below zero."""
    found = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            found.append(v)
    found += [np.array(v) for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(found)


_STEPS = np.concatenate([np.zeros((1, 8)), _shortest()])
_MIX = np.random.default_rng(_SEED).integers(1, 2 ** 63, 8, dtype=np.int64).astype(np.uint64) | np.uint64(1)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: where it is odd, the worst coordinate goes the other way."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(1) % 2 != 0)
    off = x[odd] - r[odd]
    worst = np.abs(off).argmax(1)
    r[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return r


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, which is the even integer points and the same moved by a half."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


def _name(cells: np.ndarray) -> np.ndarray:
    """Cells as numbers of 64 bits."""
    return ((2 * cells).astype(np.int64).astype(np.uint64) * _MIX).sum(-1, dtype=np.uint64).view(np.int64)


class Lattice:
    """Projections of vectors of one length."""

    def __init__(self, dimensions: int, tables: int, probes: int, scale: float):
        rng = np.random.default_rng([_SEED, dimensions])
        self.tables, self.probes = tables, probes
        self.projections = [rng.normal(size=(dimensions, 8)) * scale for _ in range(tables)]
        self.shifts = [rng.random(8) for _ in range(tables)]

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """own[i, t], the cell of vector i in table t, and near[i, t, :], the cells probed for it."""
        own = np.empty((len(unit), self.tables), np.int64)
        near = np.empty((len(unit), self.tables, self.probes), np.int64)
        for at in range(0, len(unit), 2048):
            for t in range(self.tables):
                x = unit[at:at + 2048] @ self.projections[t] + self.shifts[t]
                center = decode(x)
                off = x - center
                # |off - step|^2 without the part that all steps share
                far = (_STEPS ** 2).sum(1) - 2 * off @ _STEPS.T
                step = np.argsort(far, axis=1, kind="stable")[:, : self.probes]
                own[at:at + 2048, t] = _name(center)
                near[at:at + 2048, t] = _name(center[:, None] + _STEPS[step])
        return own, near


def _unit(flat: np.ndarray, dimensions: int) -> np.ndarray:
    x = np.asarray(flat, np.float64).reshape(-1, dimensions)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def usable(embedding: str) -> Column:
    """Neither null nor zero, all components finite."""
    bad = F.exists(embedding, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    some = F.exists(embedding, lambda v: v != 0)
    return F.coalesce(F.col(embedding).isNotNull() & ~bad & some, F.lit(False))


def _entries(settings: tuple[int, int, float]):
    """(id, key, label, d) once for each table as a member of its cell, and once for each cell probed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Lattice] = {}
        for batch in batches:
            ids, keys, labels, lists = (*(batch.column(i).to_numpy() for i in (0, 1)), batch.column(2), batch.column(3))
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for d in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == d)
                lattice = made.setdefault(d, Lattice(d, *settings))
                own, near = lattice.cells(_unit(flat[starts[rows][:, None] + np.arange(d)], d))
                for t in range(lattice.tables):
                    cell = np.concatenate([own[:, t], near[:, t].ravel()])
                    who = np.concatenate([rows, np.repeat(rows, lattice.probes)])
                    probe = np.arange(len(cell)) >= len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[who]), pa.array(keys[who]), labels.take(pa.array(who)), pa.array(np.full(len(who), d, np.int32)),
                         pa.array(np.full(len(who), t, np.int32)), pa.array(cell), pa.array(probe)],
                        ["id", "key", "label", "d", "t", "cell", "probe"],
                    )

    return run


def _compare(settings: tuple[int, int, float], least: float):
    """Per chunk of a cell: links counted for each member, and edges that connect what is linked.

    A pair may meet in several tables, and from both sides. It is counted where it meets first:
    in the first table, and there where the smaller id probes for the larger one.
    """

    def first_here(lattice: Lattice, t: int, query: np.ndarray, member: np.ndarray, qi: np.ndarray, mi: np.ndarray,
                   forward: np.ndarray) -> np.ndarray:
        q_own, q_near = lattice.cells(query)
        m_own, m_near = lattice.cells(member)
        fresh = np.ones(len(qi), bool)
        for at in range(0, len(qi), 1 << 16):
            part = slice(at, at + (1 << 16))
            q, m = qi[part], mi[part]
            for u in range(t + 1):
                from_query = (q_near[q, u] == m_own[m, u][:, None]).any(1)
                from_member = (m_near[m, u] == q_own[q, u][:, None]).any(1)
                if u < t:
                    fresh[part] &= ~(from_query | from_member)
                else:  # here it was found from the query; that counts unless the other side comes first
                    fresh[part] &= forward[part] | ~from_member
        return fresh

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Lattice] = {}
        for batch in batches:
            ends = batch.column(2).offsets.to_numpy()
            flat = batch.column(2).flatten()
            ids, keys, copies = (flat.field(c).to_numpy() for c in ("id", "key", "n"))
            probe = flat.field("probe").to_numpy(zero_copy_only=False)
            vectors = flat.field("v").flatten().to_numpy(zero_copy_only=False)
            start = 0
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for i, (d, t) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                a, b = ends[i] - ends[0], ends[i + 1] - ends[0]
                unit = _unit(vectors[start:start + (b - a) * d], d)
                start += (b - a) * d
                asks = probe[a:b]
                query, member = np.flatnonzero(asks), np.flatnonzero(~asks)
                own = ids[a:b]
                near = (unit[query] @ unit[member].T >= least) & (own[query][:, None] != own[member][None, :])
                qi, mi = np.nonzero(near)
                if not len(qi):
                    continue
                lattice = made.setdefault(d, Lattice(d, *settings))
                used_q, qi = np.unique(qi, return_inverse=True)
                used_m, mi = np.unique(mi, return_inverse=True)
                query, member = query[used_q], member[used_m]
                forward = own[query][qi] < own[member][mi]
                fresh = first_here(lattice, t, unit[query], unit[member], qi, mi, forward)
                n = copies[a:b]
                gained = np.concatenate([
                    np.bincount(qi[fresh], n[member][mi[fresh]], len(query)), np.bincount(mi[fresh], n[query][qi[fresh]], len(member))
                ]).astype(np.int64)
                who = np.concatenate([own[query], own[member]])
                root = _join(who, np.concatenate([qi, []]).astype(np.int64), mi + len(query))
                which = np.concatenate([keys[a:b][query], keys[a:b][member]])
                for column, values in zip(out, (who, which, gained, who, root)):
                    column.append(values)
            if out[0]:
                arrays = [np.concatenate(c) for c in out]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in arrays], ["id", "key", "links", "a", "b"])

    return run


def _join(who: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest id that each of `who` reaches over the pairs (a, b) of places."""
    root = who.copy()
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        if np.array_equal(before, root):
            return root


def lattice_links(classes: DataFrame, least: float = 0.98, tables: int = TABLES, probes: int = PROBES,
                  scale: float = SCALE) -> DataFrame:
    """(id, key, links, a, b): links found for a vector in one place, an edge (a, b) that connects it there.

    classes holds id, key (a hash that tells vectors of one id apart), label, v (a usable vector) and
    n (how many rows it stands for). With the
    settings given, a pair at cosine 0.98 is missed by one table with a chance below 2 %, by all
    four below 1 in a million; larger collections want a larger scale (fewer vectors in a cell)
    with more tables or probes. Vectors are only sent to cells where two of them meet. A cell with
    many members is compared in chunks, each pair of chunks a task's row of its own.
    """
    settings = (tables, probes, scale)
    entries = checkpointed(
        classes.select("id", "key", "label", "v").mapInArrow(
            _entries(settings), "id bigint, key bigint, label string, d int, t int, cell bigint, probe boolean"
        )
    )
    cell = ["label", "d", "t", "cell"]
    sizes = (
        entries.groupBy(*cell)
        .agg(F.count_if("probe").alias("asking"), F.count_if(~F.col("probe")).alias("here"),
             F.min("id").alias("least"), F.max("id").alias("most"))
        .filter("here > 0 and least <> most").drop("least", "most")
    )
    slots = lambda n: F.ceil(F.col(n) / _CHUNK).cast("int")
    met = entries.join(checkpointed(sizes), cell)
    own = F.pmod(F.xxhash64("id"), F.when(F.col("probe"), slots("asking")).otherwise(slots("here"))).cast("int")
    others = F.sequence(F.lit(0), F.when(F.col("probe"), slots("here")).otherwise(slots("asking")) - 1)
    placed = met.select(*cell, "id", "key", "probe", own.alias("own"), F.explode(others).alias("other"))
    placed = placed.select(
        *cell, "id", "key", "probe",
        F.when(F.col("probe"), F.col("own")).otherwise(F.col("other")).alias("i"),
        F.when(F.col("probe"), F.col("other")).otherwise(F.col("own")).alias("j"),
    )
    full = checkpointed(placed).join(classes.select("id", "key", "n", "v"), ["id", "key"])
    chunks = full.groupBy(*cell, "i", "j").agg(F.collect_list(F.struct("id", "key", "n", "probe", "v")).alias("members"))
    return chunks.select("d", "t", "members").mapInArrow(_compare(settings, least), "id bigint, key bigint, links bigint, a bigint, b bigint")


def embedding_groups(vectors: DataFrame, least: float = 0.98, vec_id: str = "vec_id", embedding: str = "embedding",
                     label: str = "label", **settings) -> DataFrame:
    """vectors with n_links, component_id and kept.

    Only vectors with equal labels, not null, are compared; those at a cosine of `least` or more,
    in double precision, are linked. Equal vectors of a label are linked by definition and stand
    for each other: the comparison takes one of them with their number, so that a third of all
    rows may be copies. n_links counts all other rows linked directly, component_id is the
    smallest id reached over links, kept says whether that is the row's own.

    Null labels, and vectors that are null, empty, zero or hold nulls or non-finite components,
    link with nothing: n_links 0, component_id their own id. So do rows without an id; these have
    no component and are not kept. Vectors of different lengths are never linked. An id with
    several vectors is one node, reached over any of them; each row counts its own vector's links. Empty input gives no rows. Columns
    of vectors with the names of the added ones are replaced.
    """
    vectors = without(vectors, _ADDED)
    able = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & usable(embedding)
    rows = vectors.filter(able).select(
        F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("string").alias("label"), F.col(embedding).alias("v")
    )
    same = rows.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    classes = checkpointed(same.withColumn("key", F.xxhash64("label", "v")))
    found = checkpointed(lattice_links(classes, least, **settings))
    links = found.groupBy("id", "key").agg(F.sum("links").alias("links"))
    groups = components(found.select("a", "b")).withColumnRenamed("node", "id")
    known = (
        classes.join(links, ["id", "key"], "left").join(groups, "id", "left")
        .select(F.col("label").alias("_label"), F.col("v").alias("_v"), F.coalesce("component", "id").alias("_component"),
                (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("_links"))
    )
    key = [F.when(able, F.col(label).cast("string")) == F.col("_label"), F.when(able, F.col(embedding)) == F.col("_v")]
    return (
        vectors.join(checkpointed(known), key, "left")
        .withColumn("n_links", F.coalesce("_links", F.lit(0)).cast("bigint"))
        .withColumn("component_id", F.coalesce(F.col("_component"), F.col(vec_id).cast("bigint")))
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col(vec_id), F.lit(False)))
        .drop("_label", "_v", "_component", "_links")
    )
