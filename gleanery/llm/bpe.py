"""BPE encoding and decoding with a word-end vocabulary, in batched numpy merge rounds."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without

# Fixed values of the vocabulary's file format: how it splits text, and which bytes stand for themselves.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

_CACHED_WORDS = 1 << 17  # words whose ids a task remembers; a full cache is emptied
_BLOCK = 1 << 18  # ids decoded at a time
_ROWS = 1024  # documents worked on at a time


def _byte_symbols() -> list[str]:
    """The character that stands for each byte; bytes without one of their own follow from U+0100."""
    spare = iter(range(256, 512))
    return [chr(b) if b in set(_PRINTABLE) else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Merges as sorted pair keys. Plain arrays, so that it can be broadcast (a few MB, fixed)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.size = max([*vocab.values(), *(t["id"] for t in content["added_tokens"])]) + 1
        symbols = _byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int64)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        result = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.results = keys[order], order, result[order]
        # A merge can only make pairs of a later rank where no part of a pair is made after it.
        made = np.full(self.size, -1)
        made[result] = np.arange(len(result))
        self.all_at_once = bool(
            len(set(keys.tolist())) == len(keys) == len(set(result.tolist()))
            and (made[left] < np.arange(len(left))).all() and (made[right] < np.arange(len(left))).all()
        )
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        tokens = [""] * self.size
        for token, i in [*vocab.items(), *self.special.items()]:
            tokens[i] = token
        raw = [(t + " ").encode() for t in tokens]
        self.token_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.token_sizes = np.array([len(r) for r in raw], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all words, end to end, and how many each word has. Words are not empty.

        All symbols lie in one array. A round looks up every pair of neighbours in the sorted
        keys, takes each word's lowest rank, and merges that pair wherever it stands in the word,
        from the left. Words without a known pair leave the array.
        """
        sizes = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        ids, word = self.inner[raw], np.repeat(np.arange(len(words)), sizes)
        ends = np.cumsum(sizes) - 1
        ids[ends] = self.last[raw[ends]]
        done_ids, done_words = [], []
        while len(ids):
            place, rank = self._pair_ranks(ids, word)
            best = np.full(len(words), len(self.keys), np.int64)
            np.minimum.at(best, word[:-1], rank)
            open_ = best[word] < len(self.keys)
            hit = np.flatnonzero((rank == best[word[:-1]]) & (rank < len(self.keys)))
            if not len(hit):
                done_ids.append(ids)
                done_words.append(word)
                break
            if not self.all_at_once:
                hit = hit[np.unique(word[hit], return_index=True)[1]]
            # of pairs that overlap (a a a) every other one from the left
            fresh = np.concatenate([[True], np.diff(hit) > 1])
            run = np.arange(len(hit)) - np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            hit = hit[run % 2 == 0]
            ids[hit] = self.results[place[hit]]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            done = ~open_
            if done.any():
                done_ids.append(ids[done])
                done_words.append(word[done])
                keep &= open_
            ids, word = ids[keep], word[keep]
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        ids, word = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=len(words))

    def _pair_ranks(self, ids: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in keys and rank of each pair of neighbours; unknown pairs have the last rank."""
        keys = ids[:-1] * self.size + ids[1:]
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = (self.keys[place] == keys) & (word[:-1] == word[1:])
        return place, np.where(known, self.ranks[place], len(self.keys))

    def decode(self, ids: np.ndarray) -> str:
        """The tokens of the ids with spaces between; special tokens are not skipped."""
        parts = []
        for at in range(0, len(ids), _BLOCK):
            block = ids[at:at + _BLOCK]
            sizes = self.token_sizes[block]
            ends = np.cumsum(sizes)
            source = np.repeat(self.token_starts[block] - (ends - sizes), sizes) + np.arange(int(ends[-1]))
            parts.append(self.token_bytes[source].tobytes())
        return b"".join(parts)[:-1].decode() if parts else ""


class Encoder:
    """Encodes texts of one task; remembers the ids of words it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        names = sorted(map(regex.escape, vocabulary.special), key=len, reverse=True)
        self.special = regex.compile(f"({'|'.join(names)})") if names else None
        self._forget()

    def _forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)

    def words(self, text: str) -> list[str]:
        """The text's words in order; special tokens stand as themselves."""
        if self.special is None or not self.special.search(text):
            return _SPLIT(self._normal(text))
        found = []
        for piece in self.special.split(text):
            found += [piece] if piece in self.vocabulary.special else _SPLIT(self._normal(piece))
        return found

    @staticmethod
    def _normal(text: str) -> str:
        """NFC, then each character in lower case by itself. White space only ever separates words."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """ids of each text; null counts as empty."""
        if len(self.codes) > _CACHED_WORDS:
            self._forget()
        words = [self.words(t) if t else [] for t in texts]
        codes = self.codes
        new = [w for ws in words for w in set(ws) if w not in codes]
        if new:
            self._learn(list(dict.fromkeys(new)))
        out = []
        for ws in words:
            code = np.fromiter(map(codes.__getitem__, ws), np.int64, len(ws))
            sizes = self.sizes[code]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            source = np.repeat(self.starts[code] - (ends - sizes), sizes) + np.arange(total)
            out.append(self.flat[source])
        return out

    def _learn(self, new: list[str]) -> None:
        plain = [w for w in new if w not in self.vocabulary.special]
        special = [w for w in new if w in self.vocabulary.special]
        ids, sizes = self.vocabulary.merge([w.encode("utf-8", "surrogatepass") for w in plain]) if plain else (
            np.zeros(0, np.int64), np.zeros(0, np.int64))
        ids = np.concatenate([ids, np.array([self.vocabulary.special[w] for w in special], np.int64)])
        sizes = np.concatenate([sizes, np.ones(len(special), np.int64)])
        self.codes.update({w: len(self.codes) + i for i, w in enumerate([*plain, *special])})
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.starts = np.cumsum(self.sizes) - self.sizes


def _pieces(texts: pa.Array, limit: int = 1 << 18) -> Iterator[list[str | None]]:
    """The texts of a batch in runs of up to _ROWS rows and about `limit` characters.

    What is made of a run at a time (words, ids, decoded text) stays small; one text is never cut.
    """
    run, size = [], 0
    for value in texts:
        run.append(value.as_py())
        size += len(run[-1] or "")
        if size >= limit or len(run) == _ROWS:
            yield run
            run, size = [], 0
    if run or not len(texts):
        yield run


def _ids_array(ids: list[np.ndarray], packed: bool) -> pa.Array:
    if packed:
        return pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def encode_ids(docs: DataFrame, path: str, text: str = "text", name: str = "ids", packed: bool = False) -> DataFrame:
    """docs with the token ids of the text: ARRAY<INT>, or packed as little-endian numbers of 32 bits.

    The vocabulary is read once, by the driver, from `path` and broadcast: its size is fixed.
    Each document is encoded by itself, whole. Words met before in a task are looked up, new
    ones of many documents are merged together. Strings of special tokens in a text become their
    ids. Which characters are letters is decided by the installed Unicode tables: characters that
    Unicode added after version 15.1 may be split otherwise by another library. Null and empty
    texts, and texts of white space only, have no ids (an empty array). Repeated rows stay. A
    column of docs with the new one's name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    @F.arrow_udf("binary" if packed else "array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(shared.value)
        for texts in batches:
            for run in _pieces(texts):
                yield _ids_array(encoder.encode(run), packed)

    return without(docs, [name]).withColumn(name, encode(F.col(text)))


def decode_text(docs: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """docs with the text of an ids column (ARRAY<INT>): the tokens with one space between, special ones too.

    Null ids give null, no ids the empty text. A column of docs with the new one's name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arrays in batches:
            for at in range(0, len(arrays), _ROWS):
                part = arrays[at:at + _ROWS].to_numpy(zero_copy_only=False)
                texts = [None if i is None else shared.value.decode(np.asarray(i, np.int64)) for i in part]
                yield pa.array(texts, pa.string())

    return without(docs, [name]).withColumn(name, decode(F.col(ids)))


def round_trip(docs: DataFrame, path: str, text: str = "text", packed: bool = False) -> DataFrame:
    """docs with ids, as encode_ids gives them, and decoded, the text of these ids.

    Both are made in one pass, so that a task has one Python process and ids do not go to and fro.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    @F.arrow_udf(f"struct<ids {'binary' if packed else 'array<int>'}, decoded string>")
    def transcode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(shared.value)
        for texts in batches:
            for run in _pieces(texts):
                ids = encoder.encode(run)
                decoded = pa.array([shared.value.decode(i) for i in ids], pa.string())
                yield pa.StructArray.from_arrays([_ids_array(ids, packed), decoded], ["ids", "decoded"])

    found = without(docs, ["ids", "decoded"]).withColumn("_found", transcode(F.col(text)))
    return found.withColumns({"ids": F.col("_found.ids"), "decoded": F.col("_found.decoded")}).drop("_found")
