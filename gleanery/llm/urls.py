"""URL filters: host and path rules and wildcard globs, all in one bit-parallel automaton."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without

_WORD = np.uint64(64)
_ONE = np.uint64(1)
_ADDED = ("host", "path", "rule", "verdict", "glob")


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and all paths that start with path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the contract, fixed values: the longest one that fits wins.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

#: Globs for what no rule decides, over the canonical URL: a dot, the host, the path, and the query
#: after a question mark. * is any run without a slash or question mark, ** any run, ? one byte other
#: than a slash; a backslash takes the next character as it is.
GLOBS = (
    "**spam-farm.**", "**cheap-pills.**", "*casino*/**", "*.xxx/**", "*viagra*/**", "**/wp-login.php**",
    "**/cgi-bin/**", "**.exe", r"**\?**sessionid=**",
)


def canonical(host: str, path: str, query: str) -> str:
    """What the automaton reads: ASCII only, other characters percent-encoded; no scheme, no fragment."""
    text = f".{host}{path}" + (f"?{query}" if query else "")
    return text if text.isascii() else quote(text, safe="".join(map(chr, range(33, 127))))


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host (A-Z lower-cased), path and query; all empty for null and where there is no `://`."""
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1].split("#", 1)[0]
    front, _, query = rest.partition("?")
    host, slash, path = front.partition("/")
    return host.translate(_LOWER), slash + path, query


_LOWER = {c: c + 32 for c in range(65, 91)}


class Automaton:
    """Shift-And masks of many globs, side by side in words of 64 bits.

    Each glob has a start bit, one bit for each character that it reads, and is matched when its
    last bit is on at the end of the URL. A wildcard run keeps the bit before it on: for `*` on
    any byte but a slash or question mark, for `**` on any byte. Bits move into the next word with a carry.
    """

    def __init__(self, globs: list[str]):
        tokens = [self._tokens(g) for g in globs]
        bits = sum(1 + sum(t not in ("*", "**") for t in ts) for ts in tokens)
        self.words = max(1, -(-bits // 64))
        self.reads = np.zeros((256, self.words), np.uint64)  # bits that may be entered on a byte
        self.stays = np.zeros((256, self.words), np.uint64)  # bits that stay on, on a byte
        self.start = np.zeros(self.words, np.uint64)
        self.ends: list[tuple[int, np.uint64]] = []
        at = 0
        for ts in tokens:
            self._set(self.start, at)
            for t in ts:
                if t in ("*", "**"):
                    for b in range(256):
                        if t == "**" or b not in b"/?":
                            self._set(self.stays[b], at)
                    continue
                at += 1
                for b in range(256) if t == "?" else [ord(t[-1])]:
                    if t != "?" or b != 47:
                        self._set(self.reads[b], at)
            self.ends.append((at >> 6, _ONE << np.uint64(at & 63)))
            at += 1

    @staticmethod
    def _tokens(glob: str) -> list[str]:
        """Characters, `?`, `*` and `**`; a backslash makes the next character stand for itself."""
        out, i = [], 0
        while i < len(glob):
            if glob.startswith("**", i):
                out.append("**")
                i += 2
            elif glob[i] == "\\" and i + 1 < len(glob):
                out.append("\\" + glob[i + 1])
                i += 2
            else:
                out.append(glob[i])
                i += 1
        return out

    @staticmethod
    def _set(words: np.ndarray, bit: int) -> None:
        words[bit >> 6] |= _ONE << np.uint64(bit & 63)

    def matches(self, urls: list[bytes]) -> np.ndarray:
        """matches[i, j]: whether URL i as a whole fits glob j. All URLs take a step together."""
        sizes = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-sizes, kind="stable")
        raw = np.frombuffer(b"".join(urls), np.uint8)
        starts = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        state = np.tile(self.start, (len(urls), 1))
        for i in range(int(sizes[0]) if len(urls) else 0):
            n = int(np.searchsorted(-sizes, -i, "left"))  # URLs that have a byte i
            byte = raw[starts[:n] + i]
            now = state[:n]
            moved = now << _ONE
            moved[:, 1:] |= now[:, :-1] >> (_WORD - _ONE)
            state[:n] = (moved & self.reads[byte]) | (now & self.stays[byte])
        found = np.zeros((len(urls), len(self.ends)), bool)
        for j, (word, bit) in enumerate(self.ends):
            found[order, j] = (state[:, word] & bit) != 0
        return found


def _escaped(text: str) -> str:
    return "".join("\\" + c if c in "*?\\" else c for c in canonical(text, "", "")[1:])


def judge(pages: DataFrame, rules=RULES, globs=GLOBS, url: str = "url") -> DataFrame:
    """pages with host, path, rule, verdict and glob (the first glob that fits; else null).

    The longest rule that fits gives the verdict. Where none does, a URL is blocked if any glob
    fits its canonical form, and allowed otherwise. Rules are globs too: `.host` at any dot of the
    host, then the path and anything. Rules and globs are compiled into one automaton, a constant
    of the query that is sent with it.

    A null URL, or one without `://`, has an empty host and path, fits nothing and is allowed.
    Very long URLs take as many steps as they have bytes; a batch is worked off by length.
    Repeated rows stay. Columns of pages with the names of the added ones are replaced.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.name))
    compiled = Automaton([f"*.{_escaped(r.name)}**" for r in ranked] + list(globs))

    @F.arrow_udf("struct<host string, path string, rule string, verdict string, glob string>")
    def judged(urls: pa.Array) -> pa.Array:
        parts = [split_url(u) for u in urls.to_pylist()]
        texts = [canonical(*p).encode() for p in parts]
        rule_names, verdicts, fits = [], [], []
        for at in range(0, len(texts), 4096):
            found = compiled.matches(texts[at:at + 4096])
            for row in found:
                i = next((i for i in range(len(ranked)) if row[i]), None)
                g = next((g for g, hit in zip(globs, row[len(ranked):]) if hit), None)
                rule_names.append(None if i is None else ranked[i].name)
                fits.append(g)
                verdicts.append(ranked[i].verdict if i is not None else "allow" if g is None else "block")
        columns = [[p[0] for p in parts], [p[1] for p in parts], rule_names, verdicts, fits]
        return pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], ["host", "path", "rule", "verdict", "glob"])

    found = without(pages, _ADDED).withColumn("_found", judged(F.col(url)))
    return found.withColumns({c: F.col("_found")[c] for c in _ADDED}).drop("_found")
