"""Content-hash keys of cached requests, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_LENGTH = 16  # fixed value: hex digits kept of the digest

# JSON escapes with a short form.
_SHORT_ESCAPES = {
    '"': '\\"',
    "\\": "\\\\",
    "\n": "\\n",
    "\r": "\\r",
    "\t": "\\t",
    "\b": "\\b",
    "\f": "\\f",
}


def _escaped_char(char: Column) -> Column:
    units = F.lower(F.hex(F.encode(char, "UTF-16BE")))
    plain = char.between(" ", "~")
    out = F.when(F.lit(False), char)
    for raw, escaped in _SHORT_ESCAPES.items():
        out = out.when(char == raw, F.lit(escaped))
    return out.when(plain, char).otherwise(F.regexp_replace(units, "(.{4})", r"\\u$1"))


def json_string(value: Column) -> Column:
    """Quoted JSON text in pure ASCII. The per-character path runs only where it is needed."""
    special = value.rlike(r'[^ -~]|["\\]')
    spelled = F.array_join(F.transform(F.split(value, ""), _escaped_char), "")
    return F.concat(F.lit('"'), F.when(special, spelled).otherwise(value), F.lit('"'))


def sorted_json(params: dict[str, Column], verbatim: tuple[str, ...] = ()) -> Column:
    """JSON object with sorted keys, ", " and ": " separators and explicit nulls.

    Values are text, but for the names in verbatim: those are numbers or ready JSON.
    """
    if not params:
        return F.lit("{}")
    pieces = []
    for name in sorted(params):
        value = params[name]
        shown = value.cast("string") if name in verbatim else json_string(value)
        lead = ("{" if not pieces else ", ") + f'"{name}": '
        pieces += [F.lit(lead), F.coalesce(shown, F.lit("null"))]
    return F.concat(*pieces, F.lit("}"))


def map_json(params: Column) -> Column:
    """The same for a map of text, whose keys differ from row to row."""
    entries = F.array_sort(F.map_entries(params))
    shown = F.transform(
        entries, lambda e: F.concat(json_string(e["key"]), F.lit(": "), json_string(e["value"]))
    )
    return F.concat(F.lit("{"), F.array_join(shown, ", "), F.lit("}"))


def _digest(endpoint: Column, params: Column) -> Column:
    return F.left(F.sha2(F.concat(endpoint, F.lit("|"), params), 256), F.lit(KEY_LENGTH))


def request_key(endpoint: str, params: dict[str, Column], verbatim: tuple[str, ...] = ()) -> Column:
    """Key under which the answer to a request is cached."""
    return _digest(F.lit(endpoint), sorted_json(params, verbatim))


def call_key(endpoint: Column, params: Column) -> Column:
    """Key of a free call. The endpoint counts as typed, with or without a leading slash."""
    return _digest(endpoint, map_json(params))


def batch_key(request: Column, variables: Column | None = None) -> Column:
    """Key of a batched request; variables are ready JSON, an empty object by default."""
    given = F.lit("{}") if variables is None else variables
    return request_key("graphql", {"query": request, "variables": given}, verbatim=("variables",))


def content_key(owner: Column, repo: Column, ref: Column, path: Column) -> Column:
    return request_key("contents", {"owner": owner, "repo": repo, "path": path, "ref": ref})


def history_key(owner: Column, repo: Column, path: Column) -> Column:
    """The ref is not part of a history key: two refs of one path share an answer."""
    return request_key("file_history", {"owner": owner, "repo": repo, "path": path})


def metadata_key(repo_key: Column) -> Column:
    return request_key("repo_metadata", {"repo_key": repo_key})


def search_key(query: Column, per_page: Column, page: Column) -> Column:
    return request_key(
        "search/code", {"q": query, "per_page": per_page, "page": page}, verbatim=("per_page", "page")
    )
