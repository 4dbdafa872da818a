"""Personal data: fixed patterns, and further spans found by weak supervision.

Candidate spans are voted on by labelers (pattern, shape, gazetteer, context, borders). Votes are
counted over all documents, expectation-maximisation estimates how reliable each labeler is, and a
logistic span classifier is trained on the labels this gives. Fixed-pattern spans always stay.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind string, start bigint, end bigint, base boolean, score double>>"

# Patterns of the four kinds, and of looser writings of them.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_HIDDEN_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{1,63})+", re.I
)
_HIDDEN_AT = re.compile(r"at[)\]]", re.I)
_IP6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_DOTTED_CARD = re.compile(r"(?<![0-9.])[0-9]{4}\.[0-9]{4}\.[0-9]{4}\.[0-9]{4}(?![0-9.])")
_PART_CARD = re.compile(r"(?<![0-9])(?:[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}|[0-9]{14,19})(?![0-9])")
_NATIONAL = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])")

# Gazetteers and cue words.
_ENDINGS = frozenset("com org net edu gov mil int info io eu de fr es it uk us ca au jp cn in br mx nl ch at be pl ru".split())
_COUNTRIES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48",
              "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91")
_ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[0-9]|6")
_CUES = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write|correo|courriel|reply)\b", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|client|login|adresse|dirección)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|payment|karte|carte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|téléphone|teléfono|handy)\b", re.I),
}
_FOREIGN = re.compile(r"\b(?:version|release|isbn|issn|order|invoice|item|serial|page|article|part|ticket|build|id|no|nr)\W*$", re.I)
_CONTEXT = 48

YES, NO, ABSTAIN = 1, 2, 0
LABELERS = ("pattern", "shape", "gazetteer", "context", "border")
FEATURES = ("glued left", "glued right", "own cue", "foreign cue", "shape", "listed", "fixed pattern")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain; every @ is tried with all that may stand before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order of start, then kind."""
    found = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of looser writings that touch neither a fixed-pattern span nor each other."""
    found = []
    if _HIDDEN_AT.search(text):
        found += [(m.start(), 0, m.end()) for m in _HIDDEN_EMAIL.finditer(text)]
    if _DIGIT.search(text):
        if ":" in text:
            found += [(m.start(), 1, m.end()) for m in _IP6.finditer(text)]
        found += [(m.start(), 2, m.end()) for m in _DOTTED_CARD.finditer(text)]
        found += [(m.start(), 2, m.end()) for m in _PART_CARD.finditer(text)]
        found += [(m.start(), 3, m.end()) for m in _NATIONAL.finditer(text)]
    if not found:
        return []
    # a looser span is at most a few hundred characters long, so marks per character stay cheap
    covered = {p for a, _, b in base for p in range(a, b)}
    kept, end = [], -1
    for a, k, b in sorted(found):
        if a >= end and covered.isdisjoint(range(a, b)):
            kept.append((a, k, b))
            end = b
    return kept


def describe(text: str, start: int, kind: int, end: int, base: bool) -> tuple[tuple[int, ...], int]:
    """Votes of the labelers on a span, and its features as bits."""
    span, before = text[start:end], text[max(0, start - _CONTEXT):start]
    left = start > 0 and (text[start - 1].isalnum() or text[start - 1] == "_")
    right = end < len(text) and (text[end].isalnum() or text[end] == "_")
    own, foreign = bool(_CUES[KINDS[kind]].search(before)), bool(_FOREIGN.search(before))
    digits = _digits(span)
    if kind == 0:
        ending = re.split(r"[^A-Za-z0-9-]+", span)[-1].lower()
        shape, listed = ending.isalpha() and len(ending) > 1, ending in _ENDINGS
    elif kind == 1:
        first = span.split(".")[0].lstrip("0")
        shape = ":" in span or first not in ("", "127", "255")
        listed = ":" in span or first.isdigit() and 0 < int(first) < 224
    elif kind == 2:
        shape, listed = luhn(digits), bool(_ISSUERS.match(digits))
    else:
        shape = "+" in span and span[1] != "0" or len(digits) == 10 and digits[0] not in "01" and digits[3] not in "01"
        listed = digits.startswith(_COUNTRIES) if "+" in span else digits[3:6] != "000"
    votes = (
        YES if base else ABSTAIN,
        YES if shape else NO,
        YES if listed else ABSTAIN,
        NO if foreign else YES if own else ABSTAIN,
        NO if left or right else YES,
    )
    bits = sum(b << i for i, b in enumerate((left, right, own, foreign, shape, listed, base)))
    return votes, bits


def _candidates(text: str) -> list[tuple[int, int, int, bool]]:
    base = base_spans(text)
    return sorted([(a, k, b, True) for a, k, b in base] + [(a, k, b, False) for a, k, b in loose_spans(text, base)])


def count_votes(docs: DataFrame, text: str = "text") -> DataFrame:
    """How often each (kind, votes, features) occurs among all candidates of all documents.

    At most 4 x 3^5 x 2^7 rows come out, however many documents there are; tasks count before
    anything is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for a, k, b, base in _candidates(t or ""):
                    votes, bits = describe(t, a, k, b, base)
                    counts[k, sum(v * 3 ** i for i, v in enumerate(votes)), bits] += 1
        rows = [(*key, n) for key, n in counts.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], ["kind", "votes", "bits", "n"]
        )

    found = docs.select(F.col(text)).mapInArrow(run, "kind bigint, votes bigint, bits bigint, n bigint")
    return found.groupBy("kind", "votes", "bits").agg(F.sum("n").alias("n"))


def expectation_maximisation(votes: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """(probability that each vote pattern is a true span, reliability[labeler, truth, vote]).

    Labelers are independent given the truth. Starts from the share of yes votes; every estimate
    is smoothed by one pseudo-vote, so that no labeler is ever certain.
    """
    yes, no = (votes == YES).sum(1), (votes == NO).sum(1)
    p = (yes + 0.5) / (yes + no + 1.0)
    reliability = np.full((votes.shape[1], 2, 3), 1 / 3)
    for _ in range(rounds):
        weight = np.stack([n * (1 - p), n * p])
        prior = (weight.sum(1) + 1) / (weight.sum() + 2)
        for j in range(votes.shape[1]):
            for v in range(3):
                reliability[j, :, v] = weight[:, votes[:, j] == v].sum(1) + 1
            reliability[j] /= reliability[j].sum(1, keepdims=True)
        logs = np.log(prior)[:, None] + sum(np.log(reliability[j][:, votes[:, j]]) for j in range(votes.shape[1]))
        p = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
    return p, reliability


class SpanModel:
    """One logistic classifier of span features per kind, trained on the labels of the votes."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        self.weights = np.zeros((len(KINDS), len(FEATURES) + 1))
        self.reliability: dict[str, np.ndarray] = {}
        for k, name in enumerate(KINDS):
            own = sorted(r for r in rows if r[0] == k)
            if not own:
                self.weights[k, -1] = -5.0
                continue
            votes = np.array([[r[1] // 3 ** i % 3 for i in range(len(LABELERS))] for r in own])
            n = np.array([r[3] for r in own], np.float64)
            label, self.reliability[name] = expectation_maximisation(votes, n)
            x = self._rows(np.array([r[2] for r in own]))
            self.weights[k] = self._fit(x, label, n / n.sum())

    @staticmethod
    def _rows(bits: np.ndarray) -> np.ndarray:
        x = (bits[:, None] >> np.arange(len(FEATURES)) & 1).astype(np.float64)
        return np.hstack([x, np.ones((len(x), 1))])

    @staticmethod
    def _fit(x: np.ndarray, label: np.ndarray, share: np.ndarray, rounds: int = 30) -> np.ndarray:
        """Newton steps with a weak pull towards zero."""
        w, pull = np.zeros(x.shape[1]), 1e-3
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (share * (p - label)) + pull * w
            curve = (x * (share * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
            w = w - np.linalg.solve(curve, gradient)
        return w

    def score(self, kind: int, bits: int) -> float:
        x = self._rows(np.array([bits]))[0]
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights[kind], -30, 30))))


def train(docs: DataFrame, text: str = "text") -> SpanModel:
    """A span model from the votes on all candidates of all documents."""
    return SpanModel([(r["kind"], r["votes"], r["bits"], r["n"]) for r in count_votes(docs, text).collect()])


def find_spans(docs: DataFrame, model: SpanModel, text: str = "text", name: str = "spans", least: float = 0.5) -> DataFrame:
    """docs with an array of spans (kind, start, end, base, score), by start, then kind.

    Positions are code points, the end exclusive. Fixed-pattern spans (base) always stay; looser
    ones are added where the classifier gives them at least `least`. Null and empty texts have no
    spans (an empty array); long texts are searched whole; repeated rows stay. A column of docs
    with the new one's name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(SPANS)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scores: dict[tuple[int, int], float] = {}
        for texts in batches:
            found = []
            for t in texts.to_pylist():
                spans = []
                for a, k, b, base in _candidates(t or ""):
                    _, bits = describe(t, a, k, b, base)
                    if (k, bits) not in scores:
                        scores[k, bits] = shared.value.score(k, bits)
                    if base or scores[k, bits] >= least:
                        spans.append({"kind": KINDS[k], "start": a, "end": b, "base": base, "score": scores[k, bits]})
                found.append(spans)
            yield pa.array(found, _ARROW_SPANS)

    return without(docs, [name]).withColumn(name, find(F.col(text)))


_ARROW_SPANS = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64()),
]))


def redact(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """docs with every span in the text replaced by its kind in brackets; overlapping spans by the first's.

    Null texts stay null. Everything outside the spans is kept as it is.
    """

    @F.arrow_udf("string")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for t, marks in zip(texts.to_pylist(), found.to_pylist()):
            if t is None or not marks:
                out.append(t)
                continue
            parts, end = [], 0
            for m in marks:
                if m["start"] >= end:
                    parts += [t[end:m["start"]], f"[{m['kind'].upper()}]"]
                end = max(end, m["end"])
            out.append("".join([*parts, t[end:]]))
        return pa.array(out, pa.string())

    return docs.withColumn(text, cut(F.col(text), F.col(spans)))
