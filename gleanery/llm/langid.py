"""Language identification: the family first, then one-versus-one linear SVMs within it."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import fold_of, without

#: Families of languages by code. A code that is not here is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi fo",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "baltic": "lt lv",
    "uralic": "fi et hu se",
    "turkic": "tr az kk uz tk ky tt",
    "indic": "hi ur bn mr ne pa gu",
    "semitic": "ar he mt am",
    "dravidian": "ta te kn ml",
    "celtic": "ga gd cy br",
    "sinitic": "zh yue wuu",
    "malayic": "id ms jv su",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

DIMENSIONS = 2048  # hashed features of one text
SAMPLE = 400  # labelled texts that the machines learn from, for each language
_BLOCK = 1 << 22  # bytes counted at a time
_ADDED = ("lang_pred", "score")

# Bytes that are no letters of ASCII and not part of a longer character count as a space.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang, f"only {lang}")


def features(texts: list[str | None]) -> np.ndarray:
    """Root frequencies of hashed letter n-grams of one to three bytes, a row of length 1 per text.

    Texts are lower-cased and counted whole; anything but letters is one space, so that digits
    and signs between words carry nothing. Rows of texts without letters are zero.
    """
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for i, text in enumerate(texts):
        raw = np.frombuffer((text or "").lower().encode("utf-8", "replace"), np.uint8)
        counts = np.zeros(DIMENSIONS)
        for at in range(0, len(raw), _BLOCK):
            part = _FOLD[raw[max(0, at - 2):at + _BLOCK]]
            part = part[np.concatenate([[True], (part[1:] != 32) | (part[:-1] != 32)])].astype(np.uint32)
            two = part[:-1] << np.uint32(8) | part[1:]
            three = two[:-1] << np.uint32(8) | part[2:]
            for grams, seed in ((part, 0x9E3779B1), (two, 0x85EBCA6B), (three, 0xC2B2AE35)):
                counts += np.bincount((grams * np.uint32(seed)) >> np.uint32(21), minlength=DIMENSIONS)
        total = counts.sum()
        if total:
            out[i] = np.sqrt(counts / total)
    return out


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 300) -> np.ndarray:
    """Weights, bias last, of an L2-regularised squared-hinge machine; y is +1 or -1.

    Both classes weigh the same. Accelerated gradient steps from zero: the same input gives the
    same weights.
    """
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * cost * 100
    step = 1.0 / (1.0 + 2 * (share[:, None] * x * x).sum())
    w = ahead = np.zeros(x.shape[1])
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - step * (ahead - 2 * x.T @ (share * y * slack))
        ahead, w = new + k / (k + 3) * (new - w), new
    return w


class LanguageModel:
    """Machines for families (one against the rest) and for each pair of languages of a family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families = sorted({family_of(l) for l in self.langs})
        lang, family = np.array(langs), np.array([family_of(l) for l in langs])
        self.members = {f: [l for l in self.langs if family_of(l) == f] for f in self.families}
        self.family_weights = np.array(
            [linear_svm(x, np.where(family == f, 1.0, -1.0)) for f in self.families] if len(self.families) > 1 else []
        )
        self.pairs = {}
        for f in self.families:
            for a, b in combinations(self.members[f], 2):
                of = (lang == a) | (lang == b)
                self.pairs[a, b] = linear_svm(x[of], np.where(lang[of] == a, 1.0, -1.0))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row: the family's sigmoid times the closest duel's.

        In a family, the language that wins most duels is taken; among equals the one with the
        larger sum of margins, then the first by code.
        """
        x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
        sure = np.ones(len(x))
        family = np.zeros(len(x), np.int64)
        if len(self.families) > 1:
            margins = x @ self.family_weights.T
            family = margins.argmax(1)
            sure = _sigmoid(margins.max(1))
        names = np.empty(len(x), object)
        for i, f in enumerate(self.families):
            rows, members = np.flatnonzero(family == i), self.members[f]
            wins, sums = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            least = np.full((len(rows), len(members)), np.inf)
            for (j, a), (k, b) in combinations(enumerate(members), 2):
                m = x[rows] @ self.pairs[a, b]
                wins[:, j] += m >= 0
                wins[:, k] += m < 0
                sums[:, j] += m
                sums[:, k] -= m
                least[:, j] = np.minimum(least[:, j], m)
                least[:, k] = np.minimum(least[:, k], -m)
            best = np.zeros(len(rows), np.int64)
            if len(members) > 1:
                top = wins.max(1, keepdims=True)
                best = np.where(wins == top, sums, -np.inf).argmax(1)
                sure[rows] *= _sigmoid(least[np.arange(len(rows)), best])
            names[rows] = np.array(members, object)[best]
        return names.tolist(), sure


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-2 * np.clip(margin, -20, 20)))


def _has_letter(text: str):
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def training_rows(docs: DataFrame, sample: int = SAMPLE, text: str = "text", lang: str = "lang") -> DataFrame:
    """Up to `sample` different labelled texts of each language, those with the smallest hashes.

    Only hashes are counted and ranked, and map tasks keep `sample` of them per language before the shuffle.
    The chosen hashes are written as a small table, so that its size is known before texts are
    read once more: these are joined where they are read and not shuffled.
    """
    known = docs.filter(F.col(lang).isNotNull() & _has_letter(text))
    keyed = known.select(F.col(lang).alias("lang"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))
    keys = checkpointed(keyed.select("lang", "key").distinct()).withColumn("range", F.shiftright("key", 54))
    # ranges of hashes are counted first: a common language's rows are ranked only where the smallest are
    sizes = keys.groupBy("lang", "range").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    low = sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).filter(F.col("before") < sample)
    near = keys.join(checkpointed(low.select("lang", "range")), ["lang", "range"], "left_semi")
    first = Window.partitionBy("lang").orderBy("key")
    chosen = near.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= sample).select("lang", "key")
    return keyed.join(checkpointed(chosen), ["lang", "key"]).dropDuplicates(["lang", "key"])


def train(labelled: DataFrame, sample: int = SAMPLE, text: str = "text", lang: str = "lang") -> LanguageModel | None:
    """A model from labelled texts; None where there are none.

    Features are made on the executors; the driver gets 4 KB for each of the `sample` rows of a
    language, and fits the machines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = features(batch.column("text").to_pylist()).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("key"), pa.array([r.tobytes() for r in rows], pa.binary())],
                ["lang", "key", "x"],
            )

    found = training_rows(labelled, sample, text, lang).mapInArrow(run, "lang string, key bigint, x binary")
    rows = sorted((r["lang"], r["key"], bytes(r["x"])) for r in found.collect())
    if not rows:
        return None
    x = np.array([np.frombuffer(r[2], np.float16) for r in rows], np.float32)
    return LanguageModel(x, [r[0] for r in rows])


def identify(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """docs with lang_pred and score (0 to 1), from the text alone.

    Null and empty texts, and texts without a letter, are `und` with score 0; so is everything
    where no labelled text was found (model None). Long texts are counted whole, in blocks.
    Repeated rows stay. Columns of docs with the names of the added ones are replaced.
    """
    docs = without(docs, _ADDED)
    if model is None:
        return docs.withColumn("lang_pred", F.lit("und")).withColumn("score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred string, score double>")
    def predict(texts: pa.Array) -> pa.Array:
        names, sure = [], []
        for at in range(0, len(texts), 256):
            n, s = shared.value.predict(features(texts[at:at + 256].to_pylist()))
            names += n
            sure += s.tolist()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(sure, pa.float64())], ["lang_pred", "score"])

    # Spark would put a filter on the result before the projection, and predict twice
    found = docs.withColumn("_found", predict.asNondeterministic()(F.col(text)))
    return (
        found.withColumn("lang_pred", F.when(_has_letter(text), F.col("_found.lang_pred")).otherwise("und"))
        .withColumn("score", F.when(_has_letter(text), F.col("_found.score")).otherwise(0.0))
        .drop("_found")
    )


def identify_folds(docs: DataFrame, folds: int = 5, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """docs with lang_pred, score and held_out; learnt from labelled rows that are not held out.

    A row is held out if crc32 of its id, as text, leaves no remainder by `folds`; a null id is
    not held out and not learnt from.
    """
    fold = fold_of(doc_id, folds)
    model = train(docs.filter(fold != 0), text=text, lang=lang)
    return identify(docs, model, text).withColumn("held_out", F.coalesce(fold == 0, F.lit(False)))
