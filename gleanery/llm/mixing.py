"""Mixing sources to target weights, by DataFrame functions only."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import word_count, without

# Two levels of 256 key ranges: a source is cut into up to 65,536 ranges of equal width. Keys are
# hashes, so these hold about as many rows each, and no window sees more than one of them.
_DIGITS = 256
_ADDED = ("size", "source_size", "target", "taken")


def _digit(key: Column, level: int) -> Column:
    return F.shiftrightunsigned(key, 55 - 8 * level).bitwiseAND(F.lit(_DIGITS - 1))


def _key_of(doc_id: str, seed: int) -> Column:
    """A hash of the id as a non-negative number of 63 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.lit(seed)), 1)


def source_targets(sizes: DataFrame, weights=(5, 2, 1), most: int = 3) -> DataFrame:
    """Targets of sources (source, source_size): one row each, with rank and target.

    Sources in code-point order, null last, take the weights in turn. A target is the level times
    the weight, or `most` times the source's size where that is less; the level is the one at
    which all targets add up to all sizes. It is found from above, each step capping the sources
    that the last level overfills, so that the number of steps is at most the number of different
    caps. Ranks are counted by ranges, so a million sources need no single task either.
    """
    spark = sizes.sparkSession
    ranged = checkpointed(
        sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.count("*").alias("n"))  # as many rows as shuffle partitions
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = checkpointed(
        ranged.join(starts, "part")
        .withColumn("rank", (F.col("start") + place - 1).cast("bigint"))
        .withColumn("weight", weight.cast("bigint"))
        .withColumn("cap", F.col("source_size") * most)
        .select("source", "source_size", "rank", "weight", "cap")
    )
    total, all_weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = (float(total) / all_weight if total else 0.0), -1
    while total:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        words, weight_of, n = ranked.filter(full).agg(F.sum("cap"), F.sum("weight"), F.count("*")).first()
        if n == capped or (weight_of or 0) == all_weight:
            break
        capped = n
        level = (total - (words or 0)) / (all_weight - (weight_of or 0))
    target = F.least(F.col("cap").cast("double"), F.lit(float(level)) * F.col("weight"))
    return ranked.select("source", "source_size", "rank", target.alias("target"))


def _running(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """df with `before`: the sum of size of earlier rows, by order, within the keys."""
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))


def _cut(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """The key of each source at which `rest` words are used up: cut_source, cut_key, cut_words, cut_size.

    Keys are sorted within ranges of each source; range sums, added up level by level, give every
    key its prefix sum of words. The cut is the key whose words reach over the rest.
    """
    units = rows.groupBy("source", "key").agg(F.sum("size").alias("size"))
    units = units.withColumn("d0", _digit(F.col("key"), 0)).withColumn("d1", _digit(F.col("key"), 1))
    fine = units.groupBy("source", "d0", "d1").agg(F.sum("size").alias("size"))
    coarse = fine.groupBy("source", "d0").agg(F.sum("size").alias("size"))

    def at(level: DataFrame) -> DataFrame:
        """The range, or key, in which the rest ends, with the rest as counted from its start."""
        return (
            level.filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("size")))
            .withColumn("rest", F.col("rest") - F.col("before")).drop("before")
        )

    def joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        """left with the rest of its source or range; null is a source like any other."""
        right = right.select(*[F.col(k).alias(f"of_{k}") for k in keys], "rest")
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys])
        return left.join(right, same).drop(*[f"of_{k}" for k in keys])

    in_coarse = at(joined(_running(coarse, ["source"], "d0"), budgets, ["source"]))
    in_fine = at(joined(_running(fine, ["source", "d0"], "d1"), in_coarse, ["source", "d0"]))
    in_range = at(joined(_running(units, ["source", "d0", "d1"], "key"), in_fine, ["source", "d0", "d1"]))
    return in_range.select(
        F.col("source").alias("cut_source"), F.col("key").alias("cut_key"), F.col("rest").alias("cut_words"),
        F.col("size").alias("cut_size"),
    )


def find_cuts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Where each source's budget ends: targets with epochs, cut_key, cut_tie, cut_words.

    rows holds source, key, tie and size of every document. The cut is found among the keys, then
    among the ties of the rows that share the key at the cut. A budget of whole epochs has none.
    """
    budget = F.floor("target").cast("bigint")
    rest = F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(0)
    epochs = F.when(F.col("source_size") > 0, (budget - rest) / F.col("source_size")).otherwise(0).cast("bigint")
    budgets = targets.select("source", "source_size", "target", epochs.alias("epochs"), rest.alias("rest"))
    cut = checkpointed(_cut(rows, budgets).drop("cut_size"))
    same = F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("key") == F.col("cut_key"))
    tied = rows.join(cut, same).select("source", F.col("tie").alias("key"), "size")
    ties = _cut(tied, cut.select(F.col("cut_source").alias("source"), F.col("cut_words").alias("rest"))).select(
        F.col("cut_source").alias("tie_source"), F.col("cut_key").alias("cut_tie"), "cut_words"
    )
    both = cut.drop("cut_words").join(ties, F.col("cut_source").eqNullSafe(F.col("tie_source")))
    return budgets.join(both, F.col("source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source", "tie_source", "rest")


def mix(docs: DataFrame, weights=(5, 2, 1), most: int = 3, seed: int = 42, doc_id: str = "doc_id",
        text: str = "text", source: str = "source") -> DataFrame:
    """docs with size (words), source_size, target (its source's) and taken (words the mix takes).

    Every document has a hash-random key, from its id. Within its source, in key order, documents
    are taken until the source's budget is used up to the word: whole epochs first, then all
    documents before the cut, and of the document at the cut the words that are left. Texts are
    never shuffled: the cut needs (source, key, size) only, and every row is compared with its
    source's cut. Rows that share the key at the cut (repeated or null ids) follow each other by a
    hash of their texts; full copies are counted, so that one row per source is taken in part.

    Null or empty text: size 0, taken 0. Null source: a source of its own, last in order. Null id:
    a key like any other, shared by all null ids. Empty input: no rows. Columns of docs that have
    the names of the added ones are replaced. Reruns take the same words.
    """
    key, tie = _key_of(doc_id, seed), _key_of(text, seed)
    docs = without(docs, _ADDED)
    rows = checkpointed(
        docs.select(F.col(source).alias("source"), key.alias("key"), tie.alias("tie"), word_count(text).alias("size"))
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = checkpointed(source_targets(sizes, weights, most))
    plan = checkpointed(find_cuts(rows, targets)).withColumnRenamed("source", "_source")
    joined = (
        docs.withColumn("size", word_count(text)).withColumn("_key", key).withColumn("_tie", tie)
        .join(plan, F.col(source).eqNullSafe(F.col("_source")))
    )
    at_key = F.col("_key") == F.col("cut_key")
    at_cut = F.coalesce(at_key & (F.col("_tie") == F.col("cut_tie")), F.lit(False))
    before = (F.col("_key") < F.col("cut_key")) | (at_key & (F.col("_tie") < F.col("cut_tie")))
    sure = joined.filter(~at_cut).withColumn("_part", F.when(before, F.col("size")).otherwise(0))
    copies = _numbered(checkpointed(joined.filter(at_cut).withColumn("_at", F.monotonically_increasing_id())), source)
    left = F.col("cut_words") - F.col("_number") * F.col("size")
    shared = copies.withColumn("_part", F.greatest(F.lit(0), F.least(left, F.col("size")))).drop("_number")
    return (
        sure.unionByName(shared)
        .withColumn("taken", (F.col("epochs") * F.col("size") + F.col("_part")).cast("bigint"))
        .drop("_source", "_key", "_tie", "_part", "epochs", "cut_key", "cut_tie", "cut_words")
    )


def _numbered(copies: DataFrame, source: str) -> DataFrame:
    """copies with _number from 0 in each source, counted by the partition in which `_at` was given."""
    copies = copies.withColumn("_split", F.shiftright("_at", 33))
    counts = copies.groupBy(F.col(source).alias("_of"), F.col("_split").alias("_in")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_of").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_of", "_in", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(source, "_split").orderBy("_at"))
    return (
        copies.withColumn("_place", place - 1)
        .join(starts, F.col(source).eqNullSafe(F.col("_of")) & (F.col("_split") == F.col("_in")))
        .withColumn("_number", F.col("_start") + F.col("_place")).drop("_of", "_in", "_start", "_place", "_split", "_at")
    )
