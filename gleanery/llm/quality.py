"""Quality rules whose cutoffs come from labelled holdouts with exact bounds on false rejection."""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import lgamma, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import without

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_upper", "n_letters", "n_lines")
_SYMBOLS = b"#*$%&|<>"
_KEEP_SYMBOLS = bytes(set(range(256)) - set(_SYMBOLS))
_CONTINUATION = bytes(range(128, 192))

#: Rules: a name, a numerator and a denominator of counts; a document is rejected above a cutoff.
RULES = (
    ("symbols", "n_symbols", "n_words"),
    ("repeats", "n_repeat_words", "n_words"),
    ("dup_lines", "n_dup_lines", "n_lines"),
    ("upper", "n_upper", "n_letters"),
    ("long_words", "word_chars", "n_words"),
)
BINS = 64  # candidate cutoffs of a rule
_SCALE = {"long_words": 32.0}  # the value of the highest candidate; 1 for ratios


def measure(text: str | None) -> tuple[int, ...]:
    """BASE and EXTRA of one text; null counts as empty."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    chars = sum(map(len, words)) - (0 if raw.isascii() else len(raw) - len(raw.translate(None, _CONTINUATION)))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    upper, letters = _case(text)
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), upper, letters, len(lines)


_ASCII_UPPER = bytes(range(65, 91))
_ASCII_LETTERS = _ASCII_UPPER + bytes(range(97, 123))
_OTHER_UPPER = re.compile(r"[^\x00-\x7f]")


def _case(text: str) -> tuple[int, int]:
    """Upper-case letters and all letters."""
    raw = text.encode("ascii", "ignore")
    upper, letters = len(raw) - len(raw.translate(None, _ASCII_UPPER)), len(raw) - len(raw.translate(None, _ASCII_LETTERS))
    if len(raw) < len(text):
        other = "".join(_OTHER_UPPER.findall(text))
        upper += sum(c.isupper() for c in other)
        letters += sum(c.isalpha() for c in other)
    return upper, letters


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words that lie in a window of `size` words found twice or more, the first one included."""
    if len(words) <= size:
        return 0
    code, _ = pd.factorize(np.array(words, object))
    window = code.astype(np.int64)
    for i in range(1, size):  # windows as numbers, one word longer each time
        window = window[:-1] * (int(code.max()) + 1) + code[i:]
        window, _ = pd.factorize(window)
        window = window.astype(np.int64)
    often = np.bincount(window) >= 2
    starts = often[window].astype(np.int64)
    cover = np.zeros(len(words) + 1, np.int64)
    cover[: len(starts)] += starts
    cover[size : size + len(starts)] -= starts
    return int((np.cumsum(cover)[:-1] > 0).sum())


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the counts BASE and EXTRA, of whole texts, and base_failed."""
    names = BASE + EXTRA

    @F.arrow_udf(f"struct<{', '.join(f'{n} bigint' for n in names)}>")
    def counts(texts: pa.Array) -> pa.Array:
        rows = np.array([measure(t.as_py()) for t in texts], np.int64).reshape(-1, len(names))
        return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(names))], list(names))

    docs = without(docs, (*names, "base_failed")).withColumn("_counts", counts(F.col(text)))
    docs = docs.withColumns({n: F.col("_counts")[n] for n in names}).drop("_counts")
    return docs.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def binomial_cdf(k: np.ndarray, n: np.ndarray, p: float) -> np.ndarray:
    """P(X <= k) for X ~ Binomial(n, p), exactly, term by term from the largest down."""
    out = np.empty(len(k))
    for i, (a, b) in enumerate(zip(k.tolist(), n.tolist())):
        if a >= b:
            out[i] = 1.0
        elif a < 0:
            out[i] = 0.0
        elif a > b * p:  # the shorter sum is that of the other side
            out[i] = 1.0 - _tail(b - a - 1, b, 1 - p)
        else:
            out[i] = _tail(a, b, p)
    return out


def _tail(k: int, n: int, p: float) -> float:
    """Sum of the terms 0..k, for k at or below the mean: they shrink towards 0, so the sum ends early."""
    term = np.exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log(1 - p))
    total, at = 0.0, k
    while term > 0 and term > total * 1e-17:
        total += term
        if not at:
            break
        term *= at * (1 - p) / ((n - at + 1) * p)
        at -= 1
    return min(1.0, total)


def _bin(rule: str, numerator: str, denominator: str) -> Column:
    """The candidate that a document reaches: 0 for a ratio of zero, BINS for one above all candidates."""
    ratio = F.col(numerator) / F.when(F.col(denominator) > 0, F.col(denominator))
    scaled = F.ceil(F.coalesce(ratio, F.lit(0.0)) * (BINS / _SCALE.get(rule, 1.0)))
    return F.least(scaled, F.lit(BINS)).cast("int")


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.05, error: float = 0.05,
            doc_id: str = "doc_id", quality: str = "quality") -> DataFrame:
    """(stratum, rule, cutoff): a document of the stratum is rejected if its bin is above the cutoff.

    The holdout is every labelled document that passes the base rules. For a rule and stratum,
    candidate c rejects the good documents (quality 1) with a bin above c; it is safe if the exact
    binomial bound shows, at the corrected level, that at most the rule's share of `risk` (an
    equal part, so that all rules together keep to it) of good documents are rejected.
    Candidates are tested from the loosest down, and the first that is not safe ends the tests,
    so these need no correction among themselves; rules and strata are corrected by Bonferroni:
    the level is `error` over their number. Of the safe candidates the one with the most bad
    less good documents rejected is taken, the loosest of equals; one that rejects no more bad
    documents than good ones is none. Strata without enough good documents get no cutoff.

    Documents with differing labels count once for each, and repeated ids once for each row; null
    labels do not count. Null strata are one stratum. Bins of all documents are counted on the
    executors: at most strata x rules x BINS x 2 rows are left.
    """
    marks = labels.select(F.col(doc_id).alias("_of"), F.col(quality).alias("_quality")).filter("_quality in (0, 1)").distinct()
    base = measured.filter(~F.col("base_failed"))
    held = base.join(marks, F.col(doc_id) == F.col("_of"))
    bins = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), _bin(r, a, b).alias("bin")) for r, a, b in RULES
    ]))
    counted = (
        held.select(F.col(stratum).cast("string").alias("stratum"), "_quality", bins.alias("_b"))
        .groupBy("stratum", "_b.rule", "_b.bin")
        .agg(F.sum("_quality").cast("bigint").alias("good"), F.sum(1 - F.col("_quality")).cast("bigint").alias("bad"))
    )
    counted = checkpointed(counted)
    tests = max(1, counted.select("stratum").distinct().count() * len(RULES))
    level = error / tests

    def choose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        good, bad = np.zeros(BINS + 1, np.int64), np.zeros(BINS + 1, np.int64)
        good[rows["bin"]], bad[rows["bin"]] = rows["good"], rows["bad"]
        over_good, over_bad = good[::-1].cumsum()[::-1], bad[::-1].cumsum()[::-1]  # at or above each bin
        cut, gain, total = None, 0, int(good.sum())
        for c in range(BINS - 1, -1, -1):
            bound = binomial_cdf(np.array([over_good[c + 1]]), np.array([total]), risk / len(RULES))[0]
            if bound > level:
                break
            if over_bad[c + 1] - over_good[c + 1] > gain:
                cut, gain = c, over_bad[c + 1] - over_good[c + 1]
        return pd.DataFrame({"stratum": [key[0]], "rule": [key[1]], "cutoff": [cut]}, dtype=object) if cut is not None else (
            pd.DataFrame({"stratum": [], "rule": [], "cutoff": []}, dtype=object)
        )

    return counted.groupBy("stratum", "rule").applyInPandas(choose, "stratum string, rule string, cutoff int")


def judge(measured: DataFrame, cuts: DataFrame, stratum: str = "lang") -> DataFrame:
    """measured with rejected_by, the rules whose cutoff the document is above, and kept.

    kept is false if the base rules failed or any rule rejects; strata without a cutoff keep all.
    """
    table = cuts.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cuts"))
    table = checkpointed(table.withColumnRenamed("stratum", "_stratum"))
    over = [
        F.when(_bin(r, a, b) > F.try_element_at("_cuts", F.lit(r)), F.lit(r)) for r, a, b in RULES
    ]
    joined = measured.join(table, F.col(stratum).cast("string").eqNullSafe(F.col("_stratum")), "left")
    return (
        joined.withColumn("rejected_by", F.array_compact(F.array(*over)))
        .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
        .drop("_cuts", "_stratum")
    )


def quality(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.05, error: float = 0.05,
            text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs, without the text, with counts, base_failed, rejected_by and kept.

    Texts are measured once; the counts are written and used for both the cutoffs and the
    verdicts. Null and empty texts have no words and fail the base rules. Repeated rows are
    judged alike. Empty input gives no rows; empty labels give no cutoffs. Columns of docs with
    the names of the added ones are replaced.
    """
    docs = without(docs, ("rejected_by", "kept"))
    measured = checkpointed(with_measures(docs, text).drop(text))
    return judge(measured, cutoffs(measured, labels, stratum, risk, error, doc_id), stratum)
