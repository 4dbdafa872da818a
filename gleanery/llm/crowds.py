"""Pairs worth comparing among many sets that lie around a common centre, without meeting in all pairs.

Let C be any set and D(A) what A and C do not share. A and B have a Jaccard similarity of `least`
or more exactly if |D(A)| + |D(B)| - 2 |D(A) & D(B)| <= r (|A| + |B|), r = (1 - least) / (1 + least),
which with s(A) = |D(A)| - r |A| is s(A) + s(B) <= 2 |D(A) & D(B)|. So let N be the set of least s:

* where s(A) + s(B) <= 0, both A and B are similar to N, and two pairs with N tie them together;
* all other similar pairs share members of D, as many as s(A) + s(B) asks for. With C what most of the
  sets have in common these are rare, and a set with too few that any other has can be left alone.

That holds for every C. A poor one costs time, never a pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

_NEAR = 1e-6  # for rounding, on the side of comparing


def _centred(crowded: DataFrame) -> DataFrame:
    """(centre, fp, n, group): the members of buckets by the group that most of a bucket belongs to.

    A large group of near copies has a bucket in most bands; they all get the same centre.
    """
    votes = crowded.groupBy("key", "group").agg(F.count("*").alias("votes"))
    centres = votes.groupBy("key").agg(F.max(F.struct("votes", "group")).alias("most")).select("key", F.col("most.group").alias("centre"))
    return checkpointed(crowded.join(centres, "key").select("centre", "fp", "n", "group").distinct())


def _differences(members: DataFrame, sets: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(centre, fp, n, group, s) of all members, and the (centre, fp, e) of D that can be in another D too.

    C is what more than half of a centre's members have. Sets are dealt anew before they are taken apart.
    """
    held = members.join(sets, "fp").repartition("fp")
    elements = checkpointed(held.select("centre", "fp", F.explode("set").alias("e")))
    totals = checkpointed(members.groupBy("centre").agg(F.count("*").alias("total")))
    times = elements.groupBy("centre", "e").agg(F.count("*").alias("times")).filter("times > 1")
    times = checkpointed(times.join(totals, "centre").select("centre", "e", (2 * F.col("times") > F.col("total")).alias("central")))
    centres = checkpointed(times.filter("central").groupBy("centre").agg(F.collect_list("e").alias("c")))
    c = F.coalesce("c", F.array().cast("array<bigint>"))
    lost = F.array_except(c, "set")
    r = (1 - least) / (1 + least)
    s = F.col("n") - F.size(c) + 2 * F.size(lost) - r * F.col("n")
    placed = held.join(centres, "centre", "left").select("centre", "fp", "n", "group", s.alias("s"), lost.alias("lost"))
    placed = checkpointed(placed)
    added = elements.join(times.filter("not central").select("centre", "e"), ["centre", "e"]).select("centre", "fp", "e")
    parts = added.unionByName(placed.select("centre", "fp", F.explode("lost").alias("e")))
    return placed.drop("lost"), checkpointed(parts)


def _meeting(parts: DataFrame, placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members that share enough of D with any others to be similar to one, with that number w, and the parts they share."""
    shared = parts.groupBy("centre", "e").agg(F.count("*").alias("times")).filter("times > 1")
    parts = checkpointed(parts.join(shared, ["centre", "e"]).select("centre", "fp", "e", "times"))
    w = parts.groupBy("centre", "fp").agg(F.count("*").alias("w"))
    open_ = placed.drop("w").join(w, ["centre", "fp"]).filter(F.col("s") + F.col("s_near") <= 2 * F.col("w") + _NEAR)
    open_ = checkpointed(open_)
    return open_, parts.join(open_.select("centre", "fp"), ["centre", "fp"])


def crowd_pairs(crowded: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs (fp, fp2) among which are enough to connect whatever is similar within a bucket.

    crowded has a row (key, fp, n, group) for each member of a bucket; members of one group are
    connected already. sets has the set of each fp, of n elements, without repeats. Pairs that
    cannot be similar may be among the result, and pairs of members of several buckets.
    """
    placed, parts = _differences(_centred(crowded), sets, least)
    near = checkpointed(placed.groupBy("centre").agg(F.min(F.struct("s", "fp", "group")).alias("near")))
    placed = placed.join(near, "centre").withColumn("s_near", F.col("near.s"))
    sure = F.col("s") + F.col("s_near") <= _NEAR
    other = F.col("group") != F.col("near.group")
    tied = placed.filter(sure & other).select("fp", F.col("near.fp").alias("fp2"))
    placed = placed.withColumn("inner", sure | ~other).drop("near")
    for _ in range(2):  # members left alone take with them what only they shared with others
        placed, parts = _meeting(parts.select("centre", "fp", "e"), placed)
    # of w parts one that must share `needed` of them shares one of any w - needed + 1; the rarest are taken
    needed = F.greatest(F.lit(1), F.ceil((F.col("s") + F.col("s_near")) / 2 - _NEAR))
    rank = F.row_number().over(Window.partitionBy("centre", "fp").orderBy("times", "e"))
    both = parts.join(placed, ["centre", "fp"]).select("centre", "e", "times", "fp", "n", "group", "s", "w", "inner", needed.alias("needed"))
    both = checkpointed(both)
    asks = both.filter("not inner").withColumn("rank", rank).filter("rank <= w - needed + 1").select("centre", "e", "fp", "n", "group", "s", "w")
    meets = both.select("centre", "e", *[F.col(c).alias(f"{c}2") for c in ("fp", "n", "group", "s", "w")])
    enough = F.col("s") + F.col("s2") <= 2 * F.least("w", "w2") + _NEAR
    sizes = F.least("n", "n2") >= F.lit(least) * F.greatest("n", "n2") - _NEAR
    met = asks.join(meets, ["centre", "e"]).filter((F.col("group") != F.col("group2")) & enough & sizes)
    return tied.unionByName(met.select("fp", "fp2")).distinct()
