"""Hard negatives by exact search in R-trees that are packed by sort-tile-recursive order."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

SCALE = 256  # components become floor(256 x)
SHARD = 16_384  # vectors of a shard's tree, as far as they are dealt evenly
LEAF, FANOUT = 64, 16
SAMPLE = 20_000  # vectors whose order lays out the shards; boxes are those of all vectors
PER_TILE = 32  # vectors of the sample to a tile, at least
REQUESTS = 256  # requests that travel together
BOXES = 128  # boxes of shards that travel together
_SALTS = 8
_LIMIT = 2.0 ** 25  # of a component's size in steps: products of MOST_DIMENSIONS stay within 64 bits
MOST_DIMENSIONS = 4096
LOWEST, HIGHEST = -(2 ** 62), 2 ** 62

# What a search is asked: vectors of the same label or of any other, the windows and, for each, the least score of use.
_REQUEST = "request bigint, id bigint, label bigint, x array<bigint>, lows array<bigint>, highs array<bigint>, floors array<bigint>, seed int"
_FOUND = "request bigint, w int, score bigint, id bigint"


def usable(embedding: str) -> Column:
    """Not null, not empty, all components finite and within the range of whole steps."""
    bad = F.exists(embedding, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) * SCALE >= _LIMIT))
    return F.coalesce((F.size(embedding) > 0) & ~bad, F.lit(False))


def steps(embedding: str) -> Column:
    return F.transform(embedding, lambda v: F.floor(v.cast("double") * SCALE).cast("bigint"))


# --- packing -----------------------------------------------------------------------------


def _str_order(label: np.ndarray, x: np.ndarray, leaf: int) -> np.ndarray:
    """An order in which each run of `leaf` vectors is a tile: slabs by label, then by one coordinate after the other.

    The coordinates come by falling variance; each cuts a slab into equal parts, as many as leave
    the same for the coordinates behind it.
    """
    axes = [label, *(x[:, j] for j in np.argsort(-x.var(0), kind="stable"))] if len(x) else [label]

    def tiled(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        tiles = -(-len(rows) // leaf)
        if tiles <= 1 or depth == len(axes):
            return [rows]
        slabs = max(2, int(np.ceil(tiles ** (1 / 2 if depth == 0 else 1 / (len(axes) - depth)))))
        width = -(-tiles // slabs) * leaf
        rows = rows[np.argsort(axes[depth][rows], kind="stable")]
        return [part for at in range(0, len(rows), width) for part in tiled(rows[at:at + width], depth + 1)]

    return np.concatenate(tiled(np.arange(len(label)), 0)) if len(label) else np.empty(0, np.int64)


class _Cuts:
    """The same slabs as thresholds, learnt from a sample, so that tasks can place any vector."""

    def __init__(self, label: np.ndarray, x: np.ndarray, tiles: int):
        self.axes = [-1, *np.argsort(-x.var(0), kind="stable").tolist()] if len(x) else [-1]
        self.tiles = 0
        self.root = self._cut(label, x, np.arange(len(label)), tiles, 0)

    def _cut(self, label, x, rows, tiles, depth):
        if tiles <= 1 or depth == len(self.axes) or len(rows) < 2:
            self.tiles += 1
            return self.tiles - 1
        slabs = max(2, int(np.ceil(tiles ** (1 / 2 if depth == 0 else 1 / (len(self.axes) - depth)))))
        values = (label if depth == 0 else x[:, self.axes[depth]])[rows]
        ends = np.unique(np.quantile(values, np.arange(1, slabs) / slabs, method="lower"))
        slab = np.searchsorted(ends, values)
        below = -(-tiles // slabs)
        return ends, [self._cut(label, x, rows[slab == i], below, depth + 1) for i in range(len(ends) + 1)]

    def tile(self, label: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(label), np.int32)

        def place(node, rows, depth):
            if isinstance(node, int):
                out[rows] = node
                return
            ends, below = node
            slab = np.searchsorted(ends, (label if depth == 0 else x[:, self.axes[depth]])[rows])
            for i in np.unique(slab).tolist():
                place(below[i], rows[slab == i], depth + 1)

        place(self.root, np.arange(len(label)), 0)
        return out


# --- a shard's tree ----------------------------------------------------------------------


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers; by doubles where these hold them exactly."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[-1]
    if most < 2.0 ** 52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _interval(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of x (one or more rows) with any vector of each box."""
    up, down = np.maximum(x, 0), np.minimum(x, 0)
    return _dot(up, lo) + _dot(down, hi), _dot(up, hi) + _dot(down, lo)


class _Tree:
    """Boxes above the leaves of vectors in packed order, level by level; a node's children lie next to each other."""

    def __init__(self, label: np.ndarray, x: np.ndarray, ids: list):
        self.label, self.x, self.ids = label, x, ids
        starts = np.arange(0, len(label), LEAF)
        lo, hi = np.minimum.reduceat(self.x, starts), np.maximum.reduceat(self.x, starts)
        first, last = np.minimum.reduceat(self.label, starts), np.maximum.reduceat(self.label, starts)
        self.levels = [(lo, hi, first, last)]
        while len(lo) > 1:
            starts = np.arange(0, len(lo), FANOUT)
            lo, hi = np.minimum.reduceat(lo, starts), np.maximum.reduceat(hi, starts)
            first, last = np.minimum.reduceat(first, starts), np.maximum.reduceat(last, starts)
            self.levels.append((lo, hi, first, last))

    def search(self, x, label, own, same, lows, highs, floors, k) -> list[list[tuple[int, int]]]:
        """For each window the first k (-score, id) within it, scores below its floor left out."""
        return self.search_many(x[None], np.array([label]), [own], same, [lows], [highs], [floors], k)[0]

    def search_many(self, x, labels, owns, same, lows, highs, floors, k) -> list[list[list[tuple[int, int]]]]:
        """search for many requests together, which share each box that any of them opens.

        A queue yields the box whose interval promises one of them most. A box is pruned for a
        request if its labels are not wanted, its interval lies outside all windows, or it ends
        strictly below the kth score so far (an equal score can still win by a smaller id).
        Requests with fewer windows than others have empty ones behind them.
        """
        asked, width = len(labels), max(map(len, lows), default=0)
        fill = lambda rows, value: np.array([[*r, *[value] * (width - len(r))] for r in rows], np.int64).reshape(asked, width)
        lows, highs, kth = fill(lows, HIGHEST), fill(highs, LOWEST), fill(floors, HIGHEST)
        best = [[[] for _ in range(width)] for _ in range(asked)]
        queue: list[tuple[int, int, int]] = []
        waiting: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

        def push(level: int, begin: int, end: int, who: np.ndarray) -> None:
            lo, hi, first, last = (a[begin:end] for a in self.levels[level])
            label = labels[who][:, None]
            wanted = (first <= label) & (label <= last) if same else (first != label) | (last != label)
            least, most = _interval(x[who], lo, hi)
            promise = np.full(most.shape, LOWEST - 1)
            for w in range(width):
                low, high, floor = (a[who, w][:, None] for a in (lows, highs, kth))
                reach = np.minimum(most, high)
                open_ = wanted & (most >= low) & (least <= high) & (reach >= floor)
                promise = np.where(open_, np.maximum(promise, reach), promise)
            for i in np.flatnonzero((promise >= LOWEST).any(0)).tolist():
                some = np.flatnonzero(promise[:, i] >= LOWEST)
                waiting[level, begin + i] = who[some], promise[some, i]
                heapq.heappush(queue, (-int(promise[some, i].max()), level, begin + i))

        if asked and width:
            push(len(self.levels) - 1, 0, 1, np.arange(asked))
        while queue:
            _, level, node = heapq.heappop(queue)
            who, promise = waiting.pop((level, node))
            who = who[promise >= kth[who].min(1)]
            if not len(who):
                continue
            if level:
                push(level - 1, node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1][0])), who)
                continue
            part = slice(node * LEAF, (node + 1) * LEAF)
            scores = _dot(self.x[part], x[who])
            fits = (self.label[part][:, None] == labels[who]) == same
            for w in range(width):
                rows, columns = np.nonzero((fits & (scores >= np.maximum(lows[who, w], kth[who, w])) & (scores <= highs[who, w])).T)
                for at, hits in zip(*_runs_of(rows, columns)):
                    r = who[at]
                    found = [(-int(scores[i, at]), j) for i in hits.tolist() for j in self.ids[part.start + i] if j != owns[r]]
                    best[r][w] = sorted(best[r][w] + found)[:k]
                    if len(best[r][w]) == k:
                        kth[r, w] = max(kth[r, w], -best[r][w][-1][0])
        return best


def _runs_of(rows: np.ndarray, columns: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """The distinct rows, which are sorted, and the columns of each."""
    if not len(rows):
        return [], []
    starts = np.flatnonzero(np.concatenate([[True], np.diff(rows) > 0]))
    return rows[starts].tolist(), np.split(columns, starts[1:])


def _rows_of(column: pa.Array, dtype=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(dtype)


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.RecordBatch:
    table = pa.ipc.open_stream(pa.py_buffer(data)).read_all().combine_chunks()
    return table.to_batches()[0]


def _requests_of(batch: pa.RecordBatch) -> list[tuple]:
    x = _rows_of(batch.column("x"))
    names = ("request", "id", "label", "lows", "highs", "floors", "seed")
    columns = [batch.column(n).to_pylist() for n in names]
    return [(r, i, label, x[at], *(np.array(v, np.int64) for v in (lows, highs, floors)), seed)
            for at, (r, i, label, lows, highs, floors, seed) in enumerate(zip(*columns))]


# --- index -------------------------------------------------------------------------------


def build_index(classes: DataFrame, sample: int = SAMPLE, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(shards, boxes), written, of classes (label, x, ids), vectors of one length.

    The sample, of at most `sample` vectors by the order of their hash, only says where tiles
    begin and end. All vectors are placed; a tile of more than `shard` is dealt into several
    shards by hash. Each shard is a row: its vectors, in the order of its tree, and a row of
    boxes: its bounds.
    """
    n = classes.count()
    lot = classes.orderBy(F.xxhash64("label", "x"), "label", "x").select("label", "x").limit(sample).toArrow().combine_chunks().to_batches()
    label, x = (lot[0].column("label").to_numpy(), _rows_of(lot[0].column("x"))) if lot else (np.empty(0, np.int64), np.empty((0, 1), np.int64))
    cuts = _Cuts(label, x, min(-(-n // shard), max(1, len(label) // PER_TILE)))

    @F.arrow_udf("int")
    def tile_of(labels: pa.Array, vectors: pa.Array) -> pa.Array:
        return pa.array(cuts.tile(labels.to_numpy(), _rows_of(vectors)) if len(labels) else [], pa.int32())

    placed = checkpointed(classes.withColumn("tile", tile_of("label", "x")))
    sizes = {r.tile: r.n for r in placed.groupBy("tile").agg(F.count("*").alias("n")).collect()}  # at most sample / PER_TILE
    dealt, first = placed.withColumn("shard", F.lit(0)), 0
    if sizes:
        ranges = []
        for tile, members in sorted(sizes.items()):
            slots = -(-members // shard)
            ranges += [F.lit(tile), F.struct(F.lit(first).alias("first"), F.lit(slots).alias("slots"))]
            first += slots
        at = F.element_at(F.create_map(*ranges), F.col("tile"))
        dealt = placed.withColumn("shard", (at["first"] + F.pmod(F.xxhash64("x", "label"), at["slots"])).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        labels, vectors = batch.column("label").to_numpy(), _rows_of(batch.column("x"))
        order = pa.array(_str_order(labels, vectors, LEAF))
        rows = pa.RecordBatch.from_arrays([batch.column(c).take(order) for c in ("label", "x", "ids")], ["label", "x", "ids"])
        values = [batch.column("shard")[:1], *(pa.array([v], pa.int64()) for v in (labels.min(), labels.max())),
                  *(pa.array([v.tolist()], pa.list_(pa.int64())) for v in (vectors.min(0), vectors.max(0))), pa.array([_packed(rows)], pa.binary())]
        return pa.Table.from_arrays(values, ["shard", "first", "last", "lo", "hi", "tree"])

    shape = "shard int, first bigint, last bigint, lo array<bigint>, hi array<bigint>, tree binary"
    shards = checkpointed(dealt.select("shard", "label", "x", "ids").groupBy("shard").applyInArrow(pack, shape))
    return shards.select("shard", "tree"), checkpointed(shards.drop("tree"))


# --- search ------------------------------------------------------------------------------


def _promising(requests: DataFrame, boxes: DataFrame, same: bool, best_only: bool) -> DataFrame:
    """Requests with a shard to search: the most promising one of each block of boxes, or all but the seed that may matter.

    Blocks of requests meet blocks of boxes; a request leaves with the shards whose interval
    reaches its windows, so that vectors are only ever compared in those.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, REQUESTS):
                yield pa.RecordBatch.from_arrays([pa.array([_packed(batch.slice(at, REQUESTS))], pa.binary())], ["asked"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for asked, block in zip(batch.column(0), batch.column(1)):
                rows, found = _unpacked(asked.as_py()), block.as_py()
                shard = np.array([b["shard"] for b in found], np.int32)
                first, last, lo, hi = (np.array([b[c] for b in found], np.int64) for c in ("first", "last", "lo", "hi"))
                least, most = _interval(_rows_of(rows.column("x")), lo, hi)
                take, where, promise = [], [], []
                for i, (_, _, label, _, lows, highs, floors, seed) in enumerate(_requests_of(rows)):
                    wanted = (first <= label) & (label <= last) if same else (first != label) | (last != label)
                    reach = np.minimum(most[i][:, None], highs[None])
                    open_ = wanted[:, None] & (most[i][:, None] >= lows) & (least[i][:, None] <= highs) & (reach >= floors)
                    some = np.flatnonzero(open_.any(1) & (shard != seed))
                    hopes = np.where(open_, reach, LOWEST - 1).max(1)
                    if best_only and len(some):
                        some = some[[hopes[some].argmax()]]
                    take += [i] * len(some)
                    where += shard[some].tolist()
                    promise += hopes[some].tolist()
                if take:
                    out = rows.take(pa.array(take))
                    yield pa.RecordBatch.from_arrays(
                        [*out.columns, pa.array(where, pa.int32()), pa.array(promise, pa.int64())], [*out.schema.names, "shard", "promise"]
                    )

    blocks = boxes.groupBy(F.floor(F.col("shard") / BOXES).cast("int").alias("block")).agg(
        F.collect_list(F.struct("shard", "first", "last", "lo", "hi")).alias("boxes")
    )
    blocks = checkpointed(blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))))
    every = blocks.agg(F.coalesce(F.max("block"), F.lit(-1))).first()[0]  # one number
    asked = requests.mapInArrow(bundle, "asked binary")
    if every < 0:
        return requests.limit(0).withColumns({"shard": F.lit(0), "promise": F.lit(0).cast("bigint")})
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("asked"), F.lit(_SALTS)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(every))))
    return asked.join(blocks, ["block", "salt"]).select("asked", "boxes").mapInArrow(weigh, f"{_REQUEST}, shard int, promise bigint")


def _searched(asked: DataFrame, shards: DataFrame, same: bool, k: int) -> DataFrame:
    """(request, w, score, id): the first k of each window in the shard that a request is sent to.

    The requests of a shard come in blocks, so that one that all ask for is no single group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tree = None, None
        for batch in batches:
            out = [[], [], [], []]
            for shard, asked, packed in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if shard != known:
                    rows = _unpacked(packed.as_py())
                    tree = _Tree(rows.column("label").to_numpy(), _rows_of(rows.column("x")), rows.column("ids").to_pylist())
                    known = shard
                entries = pa.RecordBatch.from_struct_array(pa.array(asked.values))
                requests, owns, labels, x, lows, highs, floors, _ = zip(*_requests_of(entries))
                answers = tree.search_many(np.stack(x), np.array(labels), owns, same, lows, highs, floors, k)
                for request, windows in zip(requests, answers):
                    for w, found in enumerate(windows):
                        for score, i in found:
                            for column, value in zip(out, (request, w, -score, i)):
                                column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["request", "w", "score", "id"])

    asked = checkpointed(asked.drop("promise"))
    counts = checkpointed(asked.groupBy("shard").agg(F.ceil(F.count("*") / REQUESTS).cast("int").alias("slots")))
    names = [c for c in asked.columns if c != "shard"]
    blocks = (
        asked.join(counts, "shard").withColumn("slot", F.pmod(F.xxhash64("request"), F.col("slots")))
        .groupBy("shard", "slot").agg(F.collect_list(F.struct(*names)).alias("asked"))
    )
    return checkpointed(blocks.join(shards, "shard").select("shard", "asked", "tree").mapInArrow(run, _FOUND))


def search(requests: DataFrame, index: tuple[DataFrame, DataFrame], same: bool, k: int) -> DataFrame:
    """(request, w, score, id, rank): the first k vectors of every window, higher scores first, then smaller ids.

    First each request is answered by the shard that promises most. The kth scores found there
    are floors for all other shards; only those whose boxes reach above or up to them are searched.
    """
    shards, boxes = index
    rest = [c for c in requests.columns if c != "request"]
    hopeful = _promising(requests, boxes, same, best_only=True)
    seeds = checkpointed(
        hopeful.groupBy("request").agg(F.max_by(F.struct(*rest, "shard", "promise"), F.struct("promise", "shard")).alias("s"))
        .select("request", "s.*")
    )
    near = _searched(seeds, shards, same, k)
    kth = near.groupBy("request", "w").agg(F.count("*").alias("n"), F.min("score").alias("kth")).filter(F.col("n") >= k)
    floors = checkpointed(kth.groupBy("request").agg(F.map_from_entries(F.collect_list(F.struct("w", "kth"))).alias("kths")))
    raised = F.transform("floors", lambda f, w: F.greatest(f, F.coalesce(F.try_element_at(F.col("kths"), w), f)))
    again = seeds.join(floors, "request", "left").withColumns({"floors": F.when(F.col("kths").isNull(), F.col("floors")).otherwise(raised), "seed": F.col("shard")})
    wide = _searched(_promising(again.select(*requests.columns), boxes, same, best_only=False), shards, same, k)
    order = Window.partitionBy("request", "w").orderBy(F.desc("score"), "id")
    return near.unionByName(wide).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", **shape) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that anchors picks.

    Scores are inner products of floor(256 x), in whole numbers. An anchor's positives are its
    first `positives` other rows of the same label; to each of these the first `negatives` rows of
    other labels are returned whose score is from `low` to `high` percent of the positive's.

    Rows without an id or label, and vectors that are null or empty or hold nulls, non-finite
    components or components of 131,072 or more, take no part; longer vectors than
    MOST_DIMENSIONS are refused. Vectors of different lengths are never compared. Rows equal in
    id, label and vector count once. Rows that share an id but differ are rows of their own, and
    anchors of their own, but never each other's positive or negative. Copies of a vector under
    many ids are one entry of the index with its first few ids, which is all that an answer can
    hold. Positives with a negative product have empty windows. Empty input gives no rows.
    """
    able = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & usable(embedding)
    picked = vectors.filter(able).select(
        F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), steps(embedding).alias("x"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    rows = checkpointed(picked.groupBy("id", "label", "x").agg(F.bool_or("anchor").alias("anchor")))
    lengths = sorted(r.d for r in rows.select(F.size("x").alias("d")).distinct().collect())
    if lengths and lengths[-1] > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {lengths[-1]} dimensions; {MOST_DIMENSIONS} at most")
    found = [_mined(rows.filter(F.size("x") == d), positives, negatives, low, high, shape) for d in lengths]
    empty = vectors.sparkSession.createDataFrame(
        [], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    )
    return reduce(DataFrame.unionByName, found) if found else empty


def _mined(rows: DataFrame, positives: int, negatives: int, low: int, high: int, shape: dict) -> DataFrame:
    # of equal vectors with one label only the first ids can be among the first k; one more, as an anchor may be one of them
    few = Window.partitionBy("label", "x").orderBy("id")
    first = rows.select("label", "x", "id").withColumn("_n", F.row_number().over(few)).filter(F.col("_n") <= max(positives, negatives) + 1)
    classes = first.groupBy("label", "x").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    index = build_index(checkpointed(classes), **shape)
    longs = lambda *v: F.array(*[F.lit(n).cast("bigint") for n in v])
    asked = checkpointed(rows.filter("anchor").select(
        F.monotonically_increasing_id().alias("request"), "id", "label", "x",
        longs(LOWEST).alias("lows"), longs(HIGHEST).alias("highs"), longs(LOWEST).alias("floors"), F.lit(-1).alias("seed"),
    ))
    near = search(asked, index, True, positives)
    windows = checkpointed(
        near.groupBy("request").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))
    )
    part = lambda p, share: p["score"].cast("decimal(20,0)") * share / 100
    wanted = checkpointed(asked.join(windows, "request").select(
        "request", "id", "label", "x",
        F.transform("positives", lambda p: F.ceil(part(p, low)).cast("bigint")).alias("lows"),
        F.transform("positives", lambda p: F.floor(part(p, high)).cast("bigint")).alias("highs"),
        F.transform("positives", lambda p: F.lit(LOWEST).cast("bigint")).alias("floors"), "seed",
    ))
    far = search(wanted, index, False, negatives)
    who = asked.select("request", F.col("id").alias("anchor_id")).join(windows, "request")
    positive = F.element_at("positives", F.col("w") + 1)
    return far.join(who, "request").select(
        "anchor_id", positive["id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        positive["score"].alias("positive_score"), F.col("score").alias("negative_score"),
    )
