"""Column expressions over file URLs and search text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The host prefix and the marker segment of a file URL.
HOST_PREFIX = "https://github.com/"
FILE_MARKER = "blob"


def _tail(url: Column) -> Column:
    """What follows the host prefix."""
    return F.substring(url, len(HOST_PREFIX) + 1, 2**31 - 1)


def is_file_url(url: Column) -> Column:
    """True for owner/repo/blob/ref/path URLs of the host; never NULL."""
    segments = url_segments(url)
    shaped = (F.size(segments) >= 5) & (F.get(segments, 2) == FILE_MARKER)
    return F.coalesce(url.startswith(HOST_PREFIX) & shaped, F.lit(False))


def url_segments(url: Column) -> Column:
    """Parts between slashes after the host."""
    return F.split(_tail(url), "/")


def url_parts(segments: Column) -> dict[str, Column]:
    """owner, repo, ref and path. Only the first segment after the marker is the ref."""
    return {
        "owner": F.get(segments, 0),
        "repo": F.get(segments, 1),
        "ref": F.get(segments, 3),
        "path": F.array_join(F.slice(segments, 5, F.greatest(F.size(segments), F.lit(0))), "/"),
    }


def on_host(url: Column) -> Column:
    """Host test of the repository listing, which ignores case."""
    return F.lower(F.left(url, F.lit(len(HOST_PREFIX)))) == HOST_PREFIX


def repo_key(url: Column) -> Column:
    """owner/repo by URL position; a part counts only when a slash closes it.

    With no slash at all after the host the owner reads as "/", so the key is "//".
    """
    segments = url_segments(url)
    owner = F.when(F.size(segments) >= 2, F.get(segments, 0)).otherwise("/")
    repo = F.when(F.size(segments) >= 3, F.get(segments, 1)).otherwise("")
    return F.concat(owner, F.lit("/"), repo)


def content_path(owner: Column, repo: Column, ref: Column, path: Column) -> Column:
    """Place of a file in the content tree."""
    return F.concat_ws("/", owner, repo, F.lit(FILE_MARKER), ref, path)


def ranged_query(query: Column, lo: Column, hi: Column) -> Column:
    """Search text limited to a closed size range."""
    return F.concat(query, F.lit(" size:"), lo.cast("string"), F.lit(".."), hi.cast("string"))


def base_query(query: Column) -> Column:
    """The search text without its size range."""
    return F.regexp_replace(query, r" size:\d+\.\.\d+$", "")


def sent_query(query: Column) -> Column:
    """Search text as the service wants it."""
    return F.replace(query, F.lit("+"), F.lit(" "))


def rooted_endpoint(endpoint: Column) -> Column:
    """Endpoint with a leading slash."""
    return F.when(endpoint.startswith("/"), endpoint).otherwise(F.concat(F.lit("/"), endpoint))


def params_map(args: Column) -> Column:
    """KEY=VALUE strings as a map: cut at the first "=", the last of equal keys wins."""

    def put(acc: Column, arg: Column) -> Column:
        key = F.substring_index(arg, "=", 1)
        value = F.substring(arg, F.length(key) + 2, F.length(arg))
        kept = F.map_filter(acc, lambda k, _: k != key)
        return F.map_concat(kept, F.create_map(key, value))

    empty = F.create_map().cast("map<string,string>")
    return F.aggregate(args, empty, put)


def normalized_path(path: Column) -> Column:
    """POSIX normal form of a relative path: no empty or "." parts, ".." taken back."""

    def step(acc: Column, part: Column) -> Column:
        climbs = (F.size(acc) > 0) & (F.element_at(acc, -1) != "..")
        return (
            F.when(part.isin("", "."), acc)
            .when((part == "..") & climbs, F.slice(acc, 1, F.size(acc) - 1))
            .otherwise(F.array_append(acc, part))
        )

    parts = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    return F.when(F.size(parts) == 0, F.lit(".")).otherwise(F.array_join(parts, "/"))


def link_destination(path: Column, target: Column) -> Column:
    """Repository path a relative link at `path` points to."""
    name = F.substring_index(path, "/", -1)
    folder = F.left(path, F.length(path) - F.length(name))
    return normalized_path(F.concat(folder, target))
