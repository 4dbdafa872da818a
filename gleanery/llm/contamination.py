"""Benchmark decontamination by a positional inverted index: phrases and near terms of test items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import without

#: A term: letters and digits of ASCII and anything beyond ASCII; A-Z are lower-cased first.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
NEAR_TERMS, NEAR = 4, 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ADDED = ("n_words", "n_hit", "n_items", "items", "contaminated", "near_items")
_ROW, _TERMS = "_contamination_row", "_contamination_terms"


def terms(text: str) -> Column:
    """The terms of a text in order; none for null."""
    found = F.regexp_extract_all(F.translate(F.col(text), _UPPER, _UPPER.lower()), F.lit(TERM), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def store_postings(docs: DataFrame, wanted: DataFrame | None = None, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The index, written: documents with a number of their own and n_words, and postings (term, doc, pos).

    The text itself is not kept. wanted (term) leaves only the postings of those terms; Spark
    broadcasts it where it is measured small, and joins by term otherwise. Postings lie in the
    partitions of their documents, so that a term found in a third of all places, or a text that
    has very many copies, is spread over all of them.
    """
    rest = [c for c in docs.columns if c.lower() != text.lower()]
    rows = checkpointed(docs.select(*rest, F.monotonically_increasing_id().alias(_ROW), terms(text).alias(_TERMS)))
    postings = rows.select(F.col(_ROW).alias("doc"), F.posexplode(_TERMS).alias("pos", "term")).select("term", "doc", "pos")
    if wanted is not None:
        postings = postings.join(wanted, "term", "left_semi")
    return rows.select(*rest, _ROW, F.size(_TERMS).cast("bigint").alias("n_words")), checkpointed(postings)


def phrases(items: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Test items as distinct sequences of terms: (unit, pos, term, size, length) and (unit, item), written.

    size is the number of terms, length that of a window: `window`, or all terms of a shorter
    item. Items without terms are left out. Equal items are one unit, known by the hash of its terms.
    """
    named = items.select(F.col(item_id).cast("string").alias("item"), terms(text).alias("terms")).filter(F.size("terms") > 0)
    named = checkpointed(named.withColumn("unit", F.sha2(F.array_join("terms", " "), 256)))
    size = F.size("terms")
    places = checkpointed(
        named.select("unit", "terms").distinct()
        .select("unit", size.alias("size"), F.least(size, F.lit(window)).alias("length"), F.posexplode("terms").alias("pos", "term"))
    )
    return places, named.select("unit", "item").distinct()


def _windows(places: DataFrame, postings: DataFrame) -> DataFrame:
    """Windows with their terms by rarity: unit, start, length and ranked, an array of (n, pos, term).

    A window with a term that no document has cannot occur and is left out.
    """
    counts = checkpointed(postings.groupBy("term").agg(F.count("*").alias("n")))
    known = places.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # a place belongs to the windows that start up to length - 1 places before it
    starts = F.sequence(F.greatest(F.lit(0), F.col("pos") - F.col("length") + 1), F.least(F.col("pos"), F.col("size") - F.col("length")))
    ranked = (
        known.select("unit", "length", "n", "pos", "term", F.explode(starts).alias("start"))
        .groupBy("unit", "start", "length").agg(F.sort_array(F.collect_list(F.struct("n", "pos", "term"))).alias("ranked"))
    )
    return checkpointed(ranked.filter(F.col("ranked")[0]["n"] > 0))


def phrase_matches(places: DataFrame, postings: DataFrame) -> DataFrame:
    """Runs (doc, unit, first, last) of document terms that are covered by windows of a unit.

    The list of a window's rarest term gives places where the unit may be aligned with a document
    (neighbouring windows mostly share it, and its list is read once). Each is intersected with
    the offset-adjusted list of the second rarest term, and what is left with those of all other
    terms of the window. Matched places without a gap, as many as a window has, are an occurrence.
    """
    windows = _windows(places, postings)
    one, two = F.col("ranked")[0], F.get("ranked", F.lit(1))
    first = checkpointed(windows.select("unit", one["pos"].alias("at"), one["term"].alias("term")).distinct())
    starts = postings.join(first, "term").select("doc", "unit", "at", (F.col("pos") - F.col("at")).alias("shift"))
    starts = checkpointed(starts)
    pairs = checkpointed(windows.select(
        "unit", "start", "length", one["pos"].alias("at"), two["pos"].alias("pos2"), two["term"].alias("term2")
    ))
    second = checkpointed(pairs.filter("term2 IS NOT NULL").select(F.col("term2").alias("term")).distinct())
    lists = postings.join(second, "term", "left_semi")
    asked = starts.join(pairs.filter("term2 IS NOT NULL"), ["unit", "at"]).select(
        "doc", "unit", "shift", "start", "length", (F.col("shift") + F.col("pos2")).alias("pos"), F.col("term2").alias("term")
    )
    alone = starts.join(pairs.filter("term2 IS NULL"), ["unit", "at"]).select("doc", "unit", "shift", "start", "length")
    kept = asked.join(lists, ["doc", "pos", "term"]).select("doc", "unit", "shift", "start", "length").unionByName(alone)
    # all terms of what is left; places shared by neighbouring windows are asked for once
    spots = kept.select("doc", "unit", "shift", "length", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at")).distinct()
    spots = checkpointed(
        spots.join(places.select("unit", F.col("pos").alias("at"), "term"), ["unit", "at"])
        .withColumn("pos", F.col("shift") + F.col("at"))
    )
    docs = checkpointed(spots.select("doc").distinct())
    met = spots.join(postings.join(docs, "doc", "left_semi"), ["doc", "pos", "term"])
    run = F.col("at") - F.row_number().over(Window.partitionBy("doc", "unit", "shift").orderBy("at"))
    return (
        met.select("doc", "unit", "length", "shift", "at", run.alias("run"))
        .groupBy("doc", "unit", "length", "shift", "run").agg(F.min("at").alias("low"), F.max("at").alias("high"))
        .filter(F.col("high") - F.col("low") + 1 >= F.col("length"))
        .select("doc", "unit", (F.col("shift") + F.col("low")).alias("first"), (F.col("shift") + F.col("high")).alias("last"))
    )


def near_matches(places: DataFrame, postings: DataFrame, rare: int = NEAR_TERMS, near: int = NEAR) -> DataFrame:
    """(doc, unit) where the rarest terms of a window stand near each other, in any order.

    Each of the window's `rare` rarest distinct terms is within `near` places of one occurrence of
    the rarest. Windows with fewer distinct terms take all they have. A list is cut into blocks
    of `near` places, so that each place meets the lists of three blocks.
    """
    windows = _windows(places, postings)
    distinct = F.array_distinct(F.transform("ranked", lambda t: F.struct(t["n"], t["term"])))
    chosen = windows.select("unit", F.slice(distinct, 1, rare).alias("chosen")).distinct()
    first = checkpointed(chosen.select(
        "unit", F.xxhash64("chosen").alias("group"), F.col("chosen")[0]["term"].alias("term"),
        F.transform(F.slice("chosen", 2, rare), lambda t: t["term"]).alias("others"),
    ))
    starts = postings.join(first, "term").select("doc", "unit", "group", F.col("pos").alias("at"), "others")
    starts = checkpointed(starts)
    alone = starts.filter(F.size("others") == 0).select("doc", "unit")
    blocks = F.sequence(F.floor((F.col("at") - near) / near), F.floor((F.col("at") + near) / near))
    asked = (
        starts.select("doc", "unit", "group", "at", F.size("others").alias("n"), F.explode("others").alias("term"))
        .withColumn("block", F.explode(blocks))
    )
    wanted = checkpointed(first.select(F.explode("others").alias("term")).distinct())
    lists = postings.join(wanted, "term", "left_semi").withColumn("block", F.floor(F.col("pos") / near))
    met = asked.join(lists, ["doc", "term", "block"]).filter(F.abs(F.col("pos") - F.col("at")) <= near)
    whole = met.groupBy("doc", "unit", "group", "at", "n").agg(F.count_distinct("term").alias("found")).filter("found = n")
    return whole.select("doc", "unit").unionByName(alone).distinct()


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", near: bool = False) -> DataFrame:
    """docs, without the text, with n_words, n_hit, n_items, items and contaminated.

    A window is `window` consecutive terms of an item, or all of a shorter one. n_hit counts the
    terms of a document inside occurrences of windows, each once however many windows or items
    cover it; items holds the ids of the items with occurrences, as text, sorted. near adds
    near_items: ids of items with a proximity match (near_matches), whether or not a phrase occurs.

    Null, empty and term-less texts have no terms and no hits, and such items match nothing.
    Repeated rows and ids are documents of their own; items with equal ids count once; an item
    without an id is matched but neither counted nor listed. Very long texts are rows of postings
    like all others. Empty tables give no rows, or no hits. Columns of docs with the names of the
    added ones are replaced.
    """
    docs = without(docs, [c for c in _ADDED if c != text.lower()])
    places, named = phrases(items, window, item_id, item_text)
    vocabulary = checkpointed(places.select("term").distinct())
    rows, postings = store_postings(docs, vocabulary, text)
    runs = checkpointed(phrase_matches(places, postings))
    # terms covered by several runs count once: each run adds what lies behind all earlier ones
    before = F.max("last").over(Window.partitionBy("doc").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("last") - F.greatest("first", F.coalesce(before + 1, F.col("first"))) + 1)
    spans = runs.select("doc", "first", "last").distinct()
    hits = spans.withColumn("fresh", fresh).groupBy("doc").agg(F.sum("fresh").cast("bigint").alias("n_hit"))

    def listed(found: DataFrame, name: str) -> DataFrame:
        ids = found.select("doc", "unit").distinct().join(named, "unit")
        return ids.groupBy("doc").agg(F.sort_array(F.collect_set("item")).alias(name))

    known = hits.join(listed(runs, "items"), "doc", "left")
    if near:
        known = known.join(listed(near_matches(places, postings), "near_items"), "doc", "full")
    known = checkpointed(known.withColumnRenamed("doc", _ROW))
    none = F.array().cast("array<string>")
    extra = [F.coalesce("near_items", none).alias("near_items")] if near else []
    ids, n_hit = F.coalesce("items", none), F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return rows.join(known, _ROW, "left").select(
        *[c for c in rows.columns if c not in (_ROW, "n_words")],
        "n_words", n_hit.alias("n_hit"), F.size(ids).cast("bigint").alias("n_items"), ids.alias("items"), (n_hit > 0).alias("contaminated"), *extra,
    )
