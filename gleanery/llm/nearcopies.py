"""Near copies by exact Jaccard similarity of word shingles.

SimHash fingerprints within three bits, found by BK-trees over shards as in simhash.py, are compared
first. A similarity of 0.8 is often further apart than three bits: MinHash bands find those pairs.
Small buckets are compared in all pairs, large ones by what their members do not share (crowds.py).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import without
from .components import components
from .crowds import crowd_pairs
from .simhash import _LOWER, fold_bits, shard_links

WORDS = 5
LEAST = 0.8
BANDS, ROWS = 24, 4  # a pair at similarity 0.8 shares no band with a chance of 3 in a million
ALIKE = 55  # equal MinHashes of a pair worth comparing; at similarity 0.8 of 96 fewer are equal once in a million pairs
BROADCAST = 1_000_000  # ids of rows, 8 MB, that are sent to all texts; more are joined
_CHUNK = 64  # members of a bucket that are compared in all pairs, at most 32 for each of them
_LEADERS = 4
_BLOCK = 8192
_draw = np.random.default_rng(42)
_TIMES = _draw.integers(0, 2 ** 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _draw.integers(0, 2 ** 63, BANDS * ROWS, dtype=np.uint64)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of `words` words; a shorter text is one shingle, one without words none."""
    tokens = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    n = max(1, len(tokens) - words + 1) if tokens else 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    return np.unique(np.array([digest(join(tokens[i:i + words]), 42) for i in range(n)], np.uint64))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def bands(found: np.ndarray) -> tuple[list[int], bytes]:
    """A key for each band of MinHashes, the number of the band being part of it, and a byte of each MinHash."""
    if not len(found):
        return [], b""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(found), _BLOCK):
        least = np.minimum(least, (found[at:at + _BLOCK, None] * _TIMES + _PLUS).min(0))
    raw, width = least.tobytes(), 8 * ROWS
    keys = [xxhash.xxh64_intdigest(raw[i * width:(i + 1) * width], i) for i in range(BANDS)]
    return np.array(keys, np.uint64).view(np.int64).tolist(), least.astype(np.uint8).tobytes()


def _sketched(words: int):
    @F.arrow_udf("struct<fp bigint, n int, simhash bigint, bands array<bigint>, sketch binary>")
    def run(texts: pa.Array) -> pa.Array:
        fps, sizes, folds, keys, sketches = [], [], [], [], []
        for t in texts:
            found = shingles(t.as_py(), words)
            fps.append(xxhash.xxh64_intdigest(found.tobytes(), 42))
            sizes.append(len(found))
            folds.append(fold_bits(found))
            for out, made in zip((keys, sketches), bands(found)):
                out.append(made)
        return pa.StructArray.from_arrays(
            [pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(np.array(folds, np.uint64).view(np.int64)),
             pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
            ["fp", "n", "simhash", "bands", "sketch"],
        )

    return run


def _alike():
    @F.arrow_udf("boolean")
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(len(x), BANDS * ROWS) for x in (left, right))
        return pa.array((a == b).sum(1) >= ALIKE, pa.bool_())

    return run


def _sets(words: int):
    @F.arrow_udf("array<bigint>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([shingles(t.as_py(), words).view(np.int64) for t in texts], pa.list_(pa.int64()))

    return run


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) that may be similar: most of a bucket are far below, which their MinHashes tell."""
    sketch = lambda side: classes.select(F.col("fp").alias(side), F.col("sketch").alias(f"s{side}"))
    likely = pairs.select("a", "b").distinct().join(sketch("a"), "a").join(sketch("b"), "b").filter(_alike()("sa", "sb"))
    return checkpointed(likely.select("a", "b"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp")))


def _shingled(used: DataFrame, rows: DataFrame, classes: DataFrame, known: DataFrame | None, text: str, words: int) -> DataFrame:
    """(fp, set) of the classes in used, each hashed once from the text of its one representative row.

    The representatives are written first. A list of up to BROADCAST of them goes to where the
    texts are; a longer one is joined, for which texts are shuffled once.
    """
    used = used.distinct()
    if known is not None:
        used = used.join(known.select("fp"), "fp", "left_anti")
    wanted = checkpointed(classes.join(used, "fp", "left_semi").select(F.col("row").alias("_row")))
    if wanted.count() <= BROADCAST:
        wanted = F.broadcast(wanted)
    texts = rows.select("_row", F.col("_fp").alias("fp"), F.col(text).alias("t")).join(wanted, "_row", "left_semi")
    fresh = checkpointed(texts.select("fp", _sets(words)("t").alias("set")))
    return fresh if known is None else known.unionByName(fresh)


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs whose sets have a similarity of at least `least`, by Spark's own functions."""
    both = (
        pairs.join(sets.select(F.col("fp").alias("a"), F.col("set").alias("sa")), "a")
        .join(sets.select(F.col("fp").alias("b"), F.col("set").alias("sb")), "b")
        .select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("n"), (F.size("sa") + F.size("sb")).alias("all"))
    )
    return checkpointed(both.filter(F.col("n") / (F.col("all") - F.col("n")) >= least).select("a", "b"))


def _fits(n: str, m: str, least: float):
    """Whether sets of these sizes can be that similar at all."""
    return F.least(n, m) >= F.lit(least) * F.greatest(n, m) - 1e-6


def _simhash_pairs(classes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) that tie together the classes whose SimHashes are linked by shards and BK-trees."""
    stands = checkpointed(classes.groupBy("simhash").agg(F.min(F.struct("fp", "n")).alias("s")))
    side = lambda name: stands.select(F.col("simhash").alias(name), F.col("s").alias(f"s{name}"))
    equal = classes.join(stands, "simhash").select("fp", "n", F.col("s.fp").alias("fp2"), F.col("s.n").alias("n2"))
    near = shard_links(stands.select(F.col("simhash").alias("fp"))).join(side("a"), "a").join(side("b"), "b")
    near = near.select(F.col("sa.fp").alias("fp"), F.col("sa.n").alias("n"), F.col("sb.fp").alias("fp2"), F.col("sb.n").alias("n2"))
    return _ordered(equal.unionByName(near).filter((F.col("fp") != F.col("fp2")) & _fits("n", "n2", least)))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("fp", "fp2").alias("a"), F.least("fp", "fp2").alias("b"))


def _with_leader(entries: DataFrame, least: float) -> DataFrame:
    """Pairs of every member of a bucket with its leader, as far as they are of different groups and like sizes."""
    leaders = checkpointed(entries.groupBy("key").agg(F.min(F.struct("place", "fp", "n", "group")).alias("leader")))
    first = entries.join(leaders, "key").filter((F.col("group") != F.col("leader.group")) & _fits("n", "leader.n", least))
    return _ordered(first.select("fp", F.col("leader.fp").alias("fp2")))


def near_copy_links(rows: DataFrame, classes: DataFrame, text: str, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """Edges (a, b) that connect the shingle sets whose similarity is at least `least`, and no others.

    Classes with linked SimHashes are compared first. Sets that share the key of a band form a
    bucket. All of a bucket are then compared with a leader, of which a large group of near copies
    has few, as leaders are drawn alike in a quarter of all bands. Of what is not yet connected,
    all pairs of a bucket of up to _CHUNK members are compared, and of larger buckets those that
    crowd_pairs gives: all that can be similar, or as many of them as connect the same.
    """
    entries = classes.select(F.col("fp"), F.col("n"), F.posexplode("bands").alias("band", "key"))
    order = F.xxhash64("fp", F.col("band") % _LEADERS)
    entries = entries.withColumn("place", order)
    shared = entries.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    met = checkpointed(entries.join(shared, "key").select("key", "fp", "n", "place", "members"))
    found = sets = groups = None

    def compared(pairs: DataFrame) -> None:
        nonlocal found, sets, groups
        likely = _likely(pairs, classes)
        sets = _shingled(_ends(likely), rows, classes, sets, text, words)
        more = _verified(likely, sets, least)
        found = more if found is None else found.unionByName(more)
        groups = checkpointed(components(found))

    def still_open() -> DataFrame:
        """Members of the buckets that are of several groups."""
        named = met.join(groups, F.col("fp") == F.col("node"), "left").withColumn("group", F.coalesce("component", "fp"))
        named = checkpointed(named.drop("node", "component"))
        unlike = named.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low <> high")
        return checkpointed(named.join(unlike.select("key"), "key"))

    compared(_simhash_pairs(classes, least))
    compared(_with_leader(still_open(), least))
    open_ = still_open()
    low = open_.filter(F.col("members") <= _CHUNK).select("key", "fp", "n", "group")
    high = low.select("key", *[F.col(c).alias(f"{c}2") for c in ("fp", "n", "group")])
    pairs = low.join(high, "key").filter((F.col("fp") > F.col("fp2")) & (F.col("group") != F.col("group2")) & _fits("n", "n2", least))
    crowded = open_.filter(F.col("members") > _CHUNK).select("key", "fp", "n", "group")
    pairs = pairs.select("fp", "fp2")
    if not crowded.isEmpty():
        sets = _shingled(crowded.select("fp"), rows, classes, sets, text, words)
        pairs = pairs.unionByName(crowd_pairs(crowded, sets, least))
    open_pairs = _likely(_ordered(pairs), classes)
    return found.unionByName(_verified(open_pairs, _shingled(_ends(open_pairs), rows, classes, sets, text, words), least))


def _grouped(docs: DataFrame, words: int, least: float, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """docs, written, with _row and _fp, and for each fp its group_fp and component_id."""
    rows = checkpointed(
        docs.withColumns({"_s": _sketched(words)(F.col(text)), "_row": F.monotonically_increasing_id()})
        .select("*", F.col("_s.fp").alias("_fp"))
    )
    # one row stands for all of an equal set; it is picked from numbers, before sketches or texts move
    chosen = checkpointed(rows.groupBy(F.col("_fp").alias("fp")).agg(F.min(doc_id).alias("least_id"), F.min("_row").alias("row")))
    sketches = rows.select(F.col("_row").alias("row"), "_s.n", "_s.simhash", "_s.bands", "_s.sketch")
    classes = checkpointed(chosen.join(sketches, "row"))
    rows = rows.drop("_s")
    groups = components(near_copy_links(rows, classes, text, words, least))
    named = classes.join(groups, classes["fp"] == groups["node"], "left").select("fp", "least_id", F.coalesce("component", "fp").alias("group_fp"))
    named = checkpointed(named)
    ids = named.groupBy("group_fp").agg(F.min("least_id").alias("component_id"))
    return rows, checkpointed(named.select("fp", "group_fp").join(ids, "group_fp"))


def near_copy_groups(docs: DataFrame, words: int = WORDS, least: float = LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with fingerprint (a hash of the set of shingles), component_id and group_fp.

    Texts are linked whose sets of `words`-word shingles have a Jaccard similarity of at least
    `least`; words are told apart by ASCII white space, in ASCII lower case. Every link is
    verified; a pair at 0.8 is missed with a chance of some millionths, a closer one with less.
    component_id is the smallest id reached over links; null ids count only where a group has no
    other. Texts with equal sets are one node. Null and empty texts, and those without words,
    are linked with each other. Empty input gives no rows. Columns of docs that bear the names of
    the added ones are replaced.
    """
    rows, known = _grouped(without(docs, ("fingerprint", "component_id", "group_fp")), words, least, doc_id, text)
    return rows.drop("_row").join(known, rows["_fp"] == known["fp"]).drop("fp").withColumnRenamed("_fp", "fingerprint")


def keep_one(docs: DataFrame, words: int = WORDS, least: float = LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The first document of each group of near_copy_groups: smallest id, null ids last; docs' own columns.

    Of rows with that id the one with the smallest hashes of its shingles and text stays. Rows
    are chosen by numbers alone. Those to be left out are few beside all: up to BROADCAST of
    them are sent to the texts, more are joined.
    """
    rows, known = _grouped(docs, words, least, doc_id, text)
    narrow = rows.select("_row", F.col("_fp").alias("fp"), F.struct(F.col(doc_id).isNull(), doc_id, "_fp", F.xxhash64(text), "_row").alias("place"))
    stays = narrow.join(known.select("fp", "group_fp"), "fp").groupBy("group_fp").agg(F.min("place").alias("place"))
    gone = checkpointed(rows.select("_row").join(stays.select(F.col("place._row").alias("_row")), "_row", "left_anti"))
    if gone.count() <= BROADCAST:
        gone = F.broadcast(gone)
    return rows.join(gone, "_row", "left_anti").select(*docs.columns)
