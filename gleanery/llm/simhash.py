"""SimHash near-duplicates: fingerprints, BK-trees over shards, groups of linked documents."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .bktree import components_within
from .common import without
from .components import components

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # five blocks of the 64 bits
_SHARD = 512  # fingerprints that one tree holds before its shard is split


def simhash(text: str | None, words: int = 3) -> int:
    """Fingerprint of one text: a bit is set if it is set in over half of the shingles' hashes."""
    tokens = (text or "").encode().translate(_LOWER).split()
    if not tokens:
        return 0
    joined, ends = b" ".join(tokens), np.cumsum([len(t) + 1 for t in tokens]) - 1
    n, last = max(1, len(tokens) - words + 1), min(words, len(tokens)) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    digest = xxhash.xxh64_intdigest
    bits = np.zeros(64, np.int64)
    stops = ends[last:].tolist()
    for at in range(0, n, 65536):  # long texts by blocks, so that the bit table stays small
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts[at:at + 65536], stops[at:at + 65536])]
        table = np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(table, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n).tobytes(), "big")


def fold_bits(hashes: np.ndarray) -> int:
    """The fingerprint of shingles that are hashed already; of none it is zero."""
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        table = hashes[at:at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(table, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes)).tobytes(), "big")


def fingerprint(text: str, words: int = 3) -> Column:
    """The fingerprint as a BIGINT with the same 64 bits; null text counts as empty."""

    @F.arrow_udf("bigint")
    def hashes(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([simhash(t, words) for t in texts.to_pylist()], np.uint64).view(np.int64))

    return hashes(F.col(text))


def _mask(fields) -> int:
    return sum(((1 << w) - 1) << s for s, w in fields)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _shards(fps: DataFrame, masks: list[int]) -> DataFrame:
    """fp once for each mask: the shard is the mask and the bits of fp below it."""
    rows = [F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for m in masks]
    return fps.select("fp", F.explode(F.array(*rows)).alias("s")).select("fp", "s.mask", "s.bits")


def _finer(mask: int, parts: int = 4) -> list[int]:
    """mask with a quarter of its free bits added, in four ways; the free bits are dealt in turn."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << b for b in free[i::parts]) for i in range(parts)]


def _split(hot: DataFrame) -> DataFrame:
    """Shards cut finer without losing a pair.

    Two fingerprints of a shard that differ in at most three bits agree on at least one of four
    fields of the free bits, so each member goes to four finer shards, one for each field. Masks
    are few, whatever the data: at most four times as many as one level above, for six levels.
    """
    spark = hot.sparkSession
    masks = [r[0] for r in hot.select("mask").distinct().collect()]
    finer = spark.createDataFrame(
        [(m, _signed(f)) for m in masks for f in _finer(m & (1 << 64) - 1)], "mask bigint, finer bigint"
    )
    return (
        hot.join(finer, "mask").select("fp", F.col("finer").alias("mask"))
        .withColumn("bits", F.col("fp").bitwiseAND(F.col("mask"))).distinct()
    )


def shard_links(fps: DataFrame, distance: int = 3, shard: int = _SHARD) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints fp which are linked, and no others.

    Shards are made so that every pair within three bits meets in one: of five blocks of bits at
    least two are equal, hence ten shards for each fingerprint, each keyed by 25 or 26 bits. A
    shard with more than `shard` members is split by further bits, again and again, until none
    is too large (nine free bits hold 512 fingerprints at most). Every shard becomes one
    BK-tree. Members of a shard are joined within its task, so that a shard of n fingerprints
    gives at most n - 1 edges, however many pairs it has.
    """
    if distance > 3:
        raise ValueError("the shards hold pairs of at most three differing bits")
    todo = _shards(fps, [_mask(pair) for pair in combinations(_BLOCKS, 2)])
    edges = None
    while True:
        todo = checkpointed(todo)
        sizes = todo.groupBy("mask", "bits").agg(F.count("*").alias("n"))
        used = checkpointed(sizes.filter("n > 1"))
        ready = checkpointed(todo.join(used.filter(F.col("n") <= shard).drop("n"), ["mask", "bits"]))
        lists = ready.groupBy("mask", "bits").agg(F.collect_list("fp").alias("fps")).select("fps")
        found = lists.mapInArrow(_link_batches(distance), "a bigint, b bigint")
        edges = found if edges is None else edges.unionByName(found)
        hot = used.filter(F.col("n") > shard).drop("n")
        if hot.isEmpty():
            return edges.distinct()
        todo = _split(todo.join(hot, ["mask", "bits"]))


def _link_batches(distance: int):
    def run(batches):
        for batch in batches:
            lists = batch.column(0)
            values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = np.diff(lists.offsets.to_numpy())
            shards = np.repeat(np.arange(len(sizes)), sizes)
            a, b = components_within(values, shards, distance)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def simhash_groups(docs: DataFrame, words: int = 3, distance: int = 3, doc_id: str = "doc_id", text: str = "text",
                   keep_text: bool = True) -> DataFrame:
    """docs with fingerprint (BIGINT), component_id and group_fp (the group's smallest fingerprint).

    component_id is the smallest id of all documents reached over links; null ids count only
    where a group has no other, and give null. Texts are hashed once: the rows are written with
    their fingerprints, and only fingerprints are compared. Equal fingerprints are one node, so
    a third of all documents may be copies of one text.

    Null and empty texts have fingerprint zero and are linked like any other; so are repeated
    rows. Empty input gives no rows. Columns of docs that bear the names of the added ones are
    replaced.
    """
    docs = without(docs, ("fingerprint", "component_id", "group_fp")).withColumn("fingerprint", fingerprint(text, words))
    rows = checkpointed(docs if keep_text else docs.drop(text))
    fps = checkpointed(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(doc_id).alias("least_id")))
    groups = components(shard_links(fps.select("fp"), distance))
    named = fps.join(groups, fps["fp"] == groups["node"], "left").withColumn("group_fp", F.coalesce("component", "fp"))
    least = named.groupBy("group_fp").agg(F.min("least_id").alias("component_id"))
    known = checkpointed(named.select("fp", "group_fp").join(least, "group_fp"))
    return rows.join(known, rows["fingerprint"] == known["fp"]).drop("fp")


def keep_one(groups: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The first document of each group: smallest id, null ids last, then smallest text.

    Map tasks drop all but one row of a group before the shuffle.
    """
    order = Window.partitionBy("group_fp").orderBy(
        F.col(doc_id).asc_nulls_last(), "fingerprint", F.col(text).asc_nulls_last()
    )
    return groups.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def hex_of(fp: str) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
