"""Column expressions over file text and report cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .urls import HOST_PREFIX

# Fixed values of the report and analysis formats.
CLIP_LENGTH = 10_000
CLIP_MARK = "\n\n[truncated]"
ELLIPSIS = "..."
URL_WIDTH = 60
TEXT_WIDTH = 120
MARKUP = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))
CELL_BAR = ("|", "&#124;")


def _without(text: Column, *pieces: str) -> Column:
    """Text without the given pieces; a byte search, far faster than a per-character one."""
    for piece in pieces:
        text = F.replace(text, F.lit(piece), F.lit(""))
    return text


def _whole_base64(digits: Column) -> Column:
    """Bytes of complete groups of four digits, else NULL."""
    return F.try_to_binary(F.when(F.char_length(digits) % 4 == 0, digits), F.lit("base64"))


def decoded_text(content: Column) -> Column:
    """Base64 content as text, U+FFFD in place of broken bytes; NULL when not base64."""
    # Most content has line breaks at most; other foreign characters take the slower path.
    plain = _whole_base64(_without(content, "\n", "\r"))
    cleaned = _whole_base64(F.regexp_replace(content, "[^A-Za-z0-9+/=]", ""))
    return F.make_valid_utf8(F.coalesce(plain, cleaned).cast("string"))


def encoded_text(text: Column) -> Column:
    """Text as base64 of its UTF-8 bytes, on one line."""
    return _without(F.base64(F.encode(text, "UTF-8")), "\r\n")


def clipped_text(text: Column, limit: int = CLIP_LENGTH) -> Column:
    """Head of a long text plus a mark; short texts unchanged."""
    head = F.concat(F.left(text, F.lit(limit)), F.lit(CLIP_MARK))
    return F.when(F.char_length(text) > limit, head).otherwise(text)


def short_url(url: Column, width: int = URL_WIDTH) -> Column:
    """URL without the host; long ones lose their middle."""
    cut = F.substring(url, len(HOST_PREFIX) + 1, 2**31 - 1)
    shown = F.when(url.startswith(HOST_PREFIX), cut).otherwise(url)
    side = F.lit((width - len(ELLIPSIS)) // 2)
    middle_cut = F.concat(F.left(shown, side), F.lit(ELLIPSIS), F.right(shown, side))
    return F.when(F.char_length(shown) > width, middle_cut).otherwise(shown)


def short_text(text: Column, width: int = TEXT_WIDTH) -> Column:
    """Text cut at the last space that fits, or hard where there is none."""
    head = F.left(text, F.lit(width - len(ELLIPSIS)))
    last_word = F.substring_index(head, " ", -1)
    at_space = F.left(head, F.char_length(head) - F.char_length(last_word) - 1)
    body = F.when(F.contains(head, F.lit(" ")), at_space).otherwise(head)
    return F.when(F.char_length(text) > width, F.concat(body, F.lit(ELLIPSIS))).otherwise(text)


def _replace_all(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def markup_escaped(text: Column) -> Column:
    """Text safe inside markup; the ampersand goes first."""
    return _replace_all(text, MARKUP)


def cell_escaped(text: Column) -> Column:
    """Markup-escaped text that does not break a table row."""
    return _replace_all(text, (*MARKUP, CELL_BAR))
