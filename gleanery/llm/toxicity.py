"""Toxicity by class-conditional Kneser-Ney models over the letters of whole words, with shared backoff counts.

A word is a run of letters and digits in lower case, of any script. Its n-grams are five code points
each, spaces standing before the word and one after it. All counts are Spark tables that grow with
the corpus: one row for every n-gram that occurs, none folded, hashed or left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import fold_of, without

ORDER = 5  # code points of an n-gram
LEAST_SYMBOLS = 8  # the ratio of a shorter word is divided by this all the same
SAMPLE = 4000  # labelled documents that the score is calibrated on
HEAD = 1 << 17  # keys that every task holds, the most frequent ones; words with others go through joins
_HELD = 1 << 17  # words a task holds before it hands their n-grams on, or forgets their sums
_RUN = 1 << 18  # symbols worked on at a time
_BEFORE = " " * (ORDER - 1)
DISCOUNT = 4.0  # taken off each count of a class: what one text says a few times is left to all documents
_ADDED = ("score", "predicted")
_WORDS = re.compile(r"[^\W_]+").findall
_MODELS = ("v", "v0", "v1")  # of all labelled documents; for those of half 0 and 1, from the other half


_ASCII = bytes((c + 32 if 65 <= c <= 90 else c) if chr(c).isalnum() and c < 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[str]:
    text = text or ""
    if text.isascii():  # the same, faster
        return text.encode().translate(_ASCII).decode().split()
    return _WORDS(text.lower())


def _runs(words: list[str]) -> Iterator[list[str]]:
    """The words in runs of about _RUN symbols; one word is never cut."""
    start = size = 0
    for i, word in enumerate(words):
        size += len(word) + ORDER
        if size >= _RUN:
            yield words[start:i + 1]
            start, size = i + 1, 0
    if start < len(words):
        yield words[start:]


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that end at each letter of a word and at the space after it, as rows of code points; their words."""
    flat = np.frombuffer("".join(f"{_BEFORE}{w} " for w in words).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    starts = np.arange(len(word)) + word * (ORDER - 1)
    return np.lib.stride_tricks.sliding_window_view(flat, ORDER)[starts], word


def _pack(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of five code points as two numbers; contexts have a zero in the last place."""
    g = grams.astype(np.uint64)
    bits = np.uint64(21)
    return ((g[:, 0] << bits | g[:, 1]) << bits) | g[:, 2], g[:, 3] << bits | g[:, 4]


def _texts(grams: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(grams, "<u4").view(f"<U{ORDER}").ravel().tolist(), pa.string())


def _count(docs: DataFrame, groups: int, group: Column, text: str) -> DataFrame:
    """(gram, n0, n1, ...): n-grams of all texts, by group; each task adds up before the shuffle."""
    names = [f"n{i}" for i in range(groups)]

    def tables(words: list[Counter]) -> Iterator[pa.RecordBatch]:
        for run in _runs(list(set().union(*words))):
            grams, word = ngrams(run)
            hi, lo = _pack(grams)
            order = np.lexsort((lo, hi))
            first = np.flatnonzero(np.concatenate([[True], (np.diff(hi[order]) != 0) | (np.diff(lo[order]) != 0)]))
            counts = [np.array([c[w] for w in run], np.int64)[word[order]] for c in words]
            sums = [pa.array(np.add.reduceat(c, first)) for c in counts]
            yield pa.RecordBatch.from_arrays([_texts(grams[order[first]]), *sums], ["gram", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [Counter() for _ in range(groups)]
        for batch in batches:
            for t, g in zip(batch.column(0), batch.column(1).to_pylist()):
                words[g].update(words_of(t.as_py()))
                if len(words[g]) > _HELD:
                    yield from tables(words)
                    words = [Counter() for _ in range(groups)]
        yield from tables(words)

    found = docs.select(F.col(text).alias("text"), group.cast("int").alias("g")).mapInArrow(
        run, "gram string, " + ", ".join(f"{n} bigint" for n in names)
    )
    return found.groupBy("gram").agg(*[F.sum(n).alias(n) for n in names])


def _context() -> Column:
    return F.expr(f"substring(gram, 1, {ORDER - 1})")


def _discount(once: int | None, twice: int | None) -> float:
    """Kneser and Ney's estimate from the n-grams seen once and twice; 0.75 where there are none."""
    return min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.75


def shared_model(every: DataFrame) -> DataFrame:
    """(gram, p): interpolated Kneser-Ney of counted n-grams (gram, n0); lower orders count the symbols before.

    The driver gets two numbers an order. The tables are those of the n-grams, joined by equality.
    """
    levels = {ORDER: every.select("gram", F.col("n0").alias("c"))}
    for k in range(ORDER - 1, 0, -1):
        shorter = levels[k + 1].groupBy(F.expr("substring(gram, 2)").alias("gram"))
        levels[k] = checkpointed(shorter.agg(F.count("*").alias("c")))
    seen = reduce(DataFrame.unionAll, [
        level.agg(F.lit(k).alias("k"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2), F.count("*"))
        for k, level in levels.items()
    ])
    seen = {row[0]: row[1:] for row in seen.collect()}
    p = None
    for k in range(1, ORDER + 1):
        d, context = F.lit(_discount(*seen[k][:2])), F.expr(f"substring(gram, 1, {k - 1})")
        level = levels[k].withColumn("context", context)
        sums = level.groupBy("context").agg(F.sum("c").alias("total"), F.count("*").alias("kinds"))
        level = level.join(sums, "context")
        if p is None:
            level = level.withColumn("lower", F.lit(1 / max(seen[1][2], 1)))
        else:
            level = level.join(p.select(F.col("gram").alias("_end"), F.col("p").alias("lower")), F.expr("substring(gram, 2)") == F.col("_end"))
        share = d * F.col("kinds") / F.col("total")
        p = level.select("gram", (F.greatest(F.col("c") - d, F.lit(0)) / F.col("total") + share * F.col("lower")).alias("p"))
    return p


def key_table(every: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, n, v, v0, v1): what n-grams and their contexts add to log p(toxic) - log p(ordinary).

    classes has counts n0 to n3 of an n-gram: ordinary ones in both halves, then toxic ones. Both
    classes discount their own counts and give what is left to the shared model, so that an
    expression rare in either is worth what it is worth in all documents, and tells nothing. The
    ratio at a symbol is the value of its n-gram plus that of its context; n-grams that no class
    has seen leave the context's alone. DISCOUNT comes off each count of a class. n is how often all documents have the key.
    """
    pairs = {"v": ("n2 + n3", "n0 + n1"), "v0": ("n3", "n1"), "v1": ("n2", "n0")}
    sides = {f"{m}_{s}": F.expr(counts) for m, both in pairs.items() for s, counts in zip("to", both)}
    counted = classes.select("gram", _context().alias("context"), *[c.alias(name) for name, c in sides.items()])
    sums = counted.groupBy("context").agg(
        *[F.sum(s).alias(f"{s}_total") for s in sides],
        *[F.sum(F.least(F.col(s), F.lit(DISCOUNT))).alias(f"{s}_off") for s in sides],
    )

    def share(s: str) -> Column:
        return F.when(F.col(f"{s}_total") > 0, F.col(f"{s}_off") / F.col(f"{s}_total")).otherwise(1.0)

    def own(s: str) -> Column:
        more = F.greatest(F.col(s) - DISCOUNT, F.lit(0)) / F.greatest(F.col(f"{s}_total"), F.lit(1))
        return more + share(s) * F.col("p")

    def ratio(of, m: str) -> Column:
        return F.log(of(f"{m}_t")) - F.log(of(f"{m}_o"))

    full = counted.join(sums, "context").join(shared_model(every), "gram")
    grams = full.select(F.col("gram").alias("key"), *[(ratio(own, m) - ratio(share, m)).alias(m) for m in pairs])
    contexts = sums.select(F.col("context").alias("key"), *[ratio(share, m).alias(m) for m in pairs])
    often = every.select(F.col("gram").alias("key"), F.col("n0").alias("n")).unionAll(
        every.groupBy(_context().alias("key")).agg(F.sum("n0").alias("n"))
    )
    return often.join(grams.unionAll(contexts), "key", "left").fillna(0.0, list(pairs)).select("key", "n", *pairs)


class Head:
    """Keys with their values, to be looked up many at a time, in a table of hashes a quarter full at most.

    A key whose place is taken goes to the next free one behind it.
    """

    def __init__(self, keys: list[str], values: list[float]):
        hi, lo = _pack(np.array(keys, f"<U{ORDER}").view("<u4").reshape(-1, ORDER))
        self.mask = (1 << max(4 * len(keys), 1).bit_length()) - 1
        self.at = np.full(self.mask + 1, -1, np.int32)
        todo, place = np.arange(len(keys)), self._place(hi, lo)
        while len(todo):
            free = todo[self.at[place[todo]] < 0]
            self.at[place[free]] = free  # of several, the last
            todo = todo[self.at[place[todo]] != todo]
            place[todo] = (place[todo] + 1) & self.mask
        self.hi, self.lo, self.values = hi, lo, np.array(values, np.float64)

    def _place(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        mixed = (hi ^ (lo << np.uint64(22))) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29)) ^ lo) * np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(32)).astype(np.int64) & self.mask

    def find(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the packed keys, 0 for those that are not there, and which are."""
        values, there = np.zeros(len(hi)), np.zeros(len(hi), bool)
        todo, place = np.arange(len(hi)), self._place(hi, lo)
        while len(todo):
            at = self.at[place]
            used = at >= 0
            todo, place, at = todo[used], place[used], at[used]
            same = (self.hi[at] == hi[todo]) & (self.lo[at] == lo[todo])
            hit = todo[same]
            values[hit], there[hit] = self.values[at[same]], True
            todo, place = todo[~same], (place[~same] + 1) & self.mask
        return values, there

    def _of(self, words: list[str]):
        grams, word = ngrams(words)
        hi, lo = _pack(grams)
        parts = [(self.find(hi, low), last) for low, last in ((lo, True), (lo >> np.uint64(21) << np.uint64(21), False))]
        return grams, word, parts

    def sums(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """What keys add for each word, and whether each has keys that are not there."""
        _, word, parts = self._of(words)
        (v1, there1), (v0, there0) = (found for found, _ in parts)
        return np.bincount(word, v1 + v0, len(words)), np.bincount(word, ~(there1 & there0), len(words)) > 0

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """What keys add for each word; whether each has keys that are not there; such keys with their words."""
        grams, word, parts = self._of(words)
        lacking, names, total = [], [], np.zeros(len(words))
        for (values, there), last in parts:
            total += np.bincount(word, values, len(words))
            lacking.append(word[~there])
            keys = grams[~there].copy()
            keys[:, -1] *= last
            names += _texts(keys).to_pylist()
        lacking = np.concatenate(lacking)
        return total, np.bincount(lacking, minlength=len(words)) > 0, lacking, names


class _Known(dict):
    """Numbers of words in the order in which they came."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class ToxicityModel:
    """The table of keys, of any size, its most frequent rows, and the calibration of the two features."""

    def __init__(self, keys: DataFrame, head: int = HEAD):
        self.keys, self.weights = keys, np.zeros(3)
        most = keys.orderBy(F.desc("n"), "key").limit(head).select("key", *_MODELS).toArrow()
        names = most.column(0).to_pylist()
        self.head = {m: Head(names, most.column(m).to_pylist()) for m in _MODELS}


def _rest_of_words(words: DataFrame, shared, model: str, keys: DataFrame) -> DataFrame:
    """(word, more): what keys outside the head add, for each of the words (distinct)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _runs(batch.column(0).to_pylist()):
                of, names = shared.value.words(part)[2:]
                found = Counter((part[i], k) for i, k in zip(of.tolist(), names))
                if found:
                    columns = [*zip(*found), list(found.values())]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["word", "key", "n"])

    found = words.mapInArrow(run, "word string, key string, n bigint")
    values = keys.select("key", F.col(model).alias("value"))
    found = found.join(values, "key", "left").withColumn("more", F.col("n") * F.coalesce("value", F.lit(0.0)))
    return checkpointed(found.groupBy("word").agg(F.sum("more").alias("more")))


_HELD_TYPE = pa.struct([
    ("total", pa.float64()), ("symbols", pa.int64()), ("most", pa.float64()),
    ("rest", pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64()), ("value", pa.float64())]))),
])


def _sums_of_texts(head: Head, texts: Iterator[list[str]], known: _Known, kept: list[np.ndarray]) -> Iterator[dict]:
    """For each text, as its words: sums over words whose keys are all in the head, and the other words.

    kept has the value, the size and the openness of all known words; texts are worked off some at a time.
    """

    def done(numbers: list[np.ndarray]) -> Iterator[dict]:
        names = list(known)
        for run in _runs(names[len(kept[0]):]):
            added = [*head.sums(run), np.array([len(w) + 1 for w in run], np.int64)]
            kept[:] = [np.concatenate(both) for both in zip(kept, added)]
        value, open_, size = kept
        flat = np.concatenate(numbers)
        doc = np.repeat(np.arange(len(numbers)), [len(n) for n in numbers])
        closed = ~open_[flat]
        total = np.bincount(doc[closed], value[flat[closed]], len(numbers))
        symbols = np.bincount(doc, size[flat], len(numbers)).astype(np.int64)
        most = np.full(len(numbers), -np.inf)
        inside, each = doc[closed], (value / np.maximum(size, LEAST_SYMBOLS))[flat[closed]]
        if len(inside):
            starts = np.flatnonzero(np.concatenate([[True], np.diff(inside) > 0]))
            most[inside[starts]] = np.maximum.reduceat(each, starts)
        pairs, times = np.unique(doc[~closed] * len(names) + flat[~closed], return_counts=True)
        rest = [[] for _ in numbers]
        for d, w, n in zip(*(a.tolist() for a in (*np.divmod(pairs, max(len(names), 1)), times))):
            rest[d].append({"word": names[w], "times": n, "value": float(value[w])})
        for row in zip(total.tolist(), symbols.tolist(), most.tolist(), rest):
            yield {"total": row[0], "symbols": row[1], "most": None if row[2] == -np.inf else row[2], "rest": row[3]}
        if len(known) > _HELD:
            known.clear()
            kept[:] = [a[:0] for a in kept]

    waiting, words = [], 0
    for text in texts:
        waiting.append(np.fromiter(map(known.__getitem__, text), np.int64, len(text)))
        words += len(text)
        if words >= _RUN:
            yield from done(waiting)
            waiting, words = [], 0
    if waiting:
        yield from done(waiting)


def features(docs: DataFrame, model: ToxicityModel, text: str = "text", which: str = "v", keep_text: bool = True) -> DataFrame:
    """docs with _mean, the log-likelihood ratio per symbol, and _most, that of the most toxic word.

    Words whose keys are all in the head are done where the text lies, once: the rows are written,
    without their texts where these are not to be kept. The other words, rare ones by the choice of
    the head, are joined to the table of keys, once per word; their sums are joined back by two
    hashes of the text, equal texts having equal features.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.head[which])

    @F.arrow_udf("struct<total double, symbols bigint, most double, rest array<struct<word string, times bigint, value double>>>")
    def held(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, kept = _Known(), [np.zeros(0), np.zeros(0, bool), np.zeros(0, np.int64)]
        for texts in batches:
            yield pa.array(list(_sums_of_texts(shared.value, (words_of(t.as_py()) for t in texts), known, kept)), _HELD_TYPE)

    key = [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(7), F.col(text)).alias("_h2")]
    rows = docs.select("*", *key, held(F.col(text)).alias("_held"))
    rows = checkpointed(rows if keep_text else rows.drop(text))
    rest = rows.select("_h1", "_h2", F.explode("_held.rest").alias("_r")).select("_h1", "_h2", "_r.*").distinct()
    more = _rest_of_words(rest.select("word").distinct(), shared, which, model.keys)
    value = F.col("value") + F.coalesce("more", F.lit(0.0))
    size = F.greatest(F.char_length("word") + 1, F.lit(LEAST_SYMBOLS))
    rest = rest.join(more, "word", "left").groupBy("_h1", "_h2").agg(
        F.sum(F.col("times") * value).alias("_total"), F.max(value / size).alias("_peak")
    )
    total = F.col("_held.total") + F.coalesce("_total", F.lit(0.0))
    return (
        rows.join(rest, ["_h1", "_h2"], "left")
        .withColumn("_mean", F.coalesce(F.try_divide(total, F.col("_held.symbols")), F.lit(0.0)))
        .withColumn("_most", F.coalesce(F.greatest("_held.most", "_peak"), F.lit(0.0)))
        .drop("_h1", "_h2", "_held", "_total", "_peak")
    )


def _columns(x: np.ndarray) -> np.ndarray:
    return np.hstack([10 * x[:, :1], x[:, 1:], np.ones((len(x), 1))])


def _calibrate(x: np.ndarray, y: np.ndarray, pull: float = 0.5, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, drawn weakly to zero; without labels the score is a half."""
    a = _columns(x) if len(x) else np.zeros((0, 3))
    w, curb = np.zeros(3), pull * np.diag([0.1, 0.1, 0.01])
    for _ in range(rounds if len(a) else 0):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        curve = (a * (p * (1 - p))[:, None]).T @ a + curb
        w = w - np.linalg.solve(curve, a.T @ (p - y) + curb @ w)
    return w


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", head: int = HEAD) -> ToxicityModel:
    """A model from texts of docs and the labels given.

    Shared counts come from all of docs, class counts from all labelled ones; both stay Spark
    tables. The driver gets the `head` most frequent keys, which every task will hold; the others
    are joined, with the same result. The calibration is fitted to `sample` labelled documents,
    those with the smallest hashes of their ids, a repeated id by one of its rows: each is scored
    by a model that has counted only the other half of the labelled documents. Null labels and
    ids do not count, and repeated labels count once. Without labels of both classes every score
    is a half.
    """
    marks = labels.select(F.col(doc_id).alias("_of"), F.col(label).cast("int").alias("_label")).filter("_label in (0, 1)").distinct()
    half = F.xxhash64("_of", F.lit(7)).bitwiseAND(F.lit(1)).cast("int")
    # labels grow with the documents, so they are never broadcast: the same plan at every size
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    labelled = texts.join(marks.hint("merge"), F.col("_id") == F.col("_of"))
    every = checkpointed(_count(docs, 1, F.lit(0), text))
    classes = checkpointed(_count(labelled, 4, 2 * F.col("_label") + half, "_text"))
    model = ToxicityModel(checkpointed(key_table(every, classes)), head)

    key = F.xxhash64("_of", F.lit(11))
    chosen = checkpointed(marks.select("_of", "_label", key.alias("_key")).orderBy("_key", "_of", "_label").limit(sample))
    picked = texts.join(chosen, F.col("_id") == F.col("_of")).groupBy("_of", "_label").agg(F.min("_text").alias("_text"))
    picked = checkpointed(picked.withColumn("_half", half))
    parts = [features(picked.filter(F.col("_half") == h), model, "_text", f"v{h}", keep_text=False) for h in (0, 1)]
    rows = sorted(tuple(r) for r in parts[0].unionAll(parts[1]).select("_mean", "_most", "_label").collect())
    if len({r[2] for r in rows}) == 2:
        model.weights = _calibrate(np.array([r[:2] for r in rows]), np.array([r[2] for r in rows]))
    return model


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", least: float = 0.7, keep_text: bool = True) -> DataFrame:
    """docs with score (0 to 1, higher: more likely toxic) and predicted (1 from `least` on).

    Whole texts are scored. Null and empty texts, and texts without a letter or digit, get the
    score of a text that tells nothing. Repeated rows are scored alike. Columns of docs with the
    names of the added ones are replaced.
    """
    mean, most, one = (float(w) for w in model.weights)
    z = 10 * mean * F.col("_mean") + most * F.col("_most") + one
    found = features(without(docs, _ADDED), model, text, keep_text=keep_text).withColumn("score", 1 / (1 + F.exp(-z)))
    return found.drop("_mean", "_most").withColumn("predicted", F.when(F.col("score") >= least, 1).otherwise(0))


def score_folds(docs: DataFrame, labels: DataFrame, folds: int = 3, doc_id: str = "doc_id", text: str = "text",
                label: str = "toxic", keep_text: bool = True) -> DataFrame:
    """docs with score, predicted and held_out; labels of held-out rows are not learnt from.

    A row is held out if crc32 of its id, as text, leaves remainder 1 by `folds`; null ids are not.
    """
    model = train(docs, labels.filter(fold_of(doc_id, folds) != 1), doc_id=doc_id, text=text, label=label)
    return score(docs, model, text, keep_text=keep_text).withColumn("held_out", F.coalesce(fold_of(doc_id, folds) == 1, F.lit(False)))
