"""Declared schemas of the state tables and of the landed responses."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


STRING, LONG, INT, TIME, BOOLEAN = StringType(), LongType(), IntegerType(), TimestampType(), BooleanType()

COMMIT = _struct(sha=STRING, author=STRING, date=STRING, message=STRING)

FILES = StructType(
    [
        StructField("url", STRING, False),
        StructField("sha", STRING),
        StructField("size_bytes", LONG),
        StructField("discovered_at", TIME),
        StructField("seq", LONG),
    ]
)

REPO_METADATA = _struct(
    repo_key=STRING,
    stars=LONG,
    forks=LONG,
    watchers=LONG,
    language=STRING,
    topics=ArrayType(STRING),
    created_at=STRING,
    updated_at=STRING,
    pushed_at=STRING,
    default_branch=STRING,
    license=STRING,
    description=STRING,
    fetched_at=TIME,
)

FILE_HISTORY = _struct(url=STRING, commits=ArrayType(COMMIT), fetched_at=TIME)

SEARCH_HITS = _struct(url=STRING, query=STRING, size_min=LONG, size_max=LONG, hit_at=TIME)

CONTENT_STATUS = _struct(url=STRING, status=STRING, fetched_at=TIME)

SCAN_PROGRESS = _struct(
    query=STRING, last_lo=LONG, max_size=LONG, collected=LONG, completed_at=TIME, updated_at=TIME
)

# Where the scan of each query stands, and what its last range was marked with.
SCAN_RANGES = _struct(query=STRING, lo=LONG, chunk=LONG, empties=LONG, completed=BOOLEAN, action=STRING, scan=LONG)

# Pieces of ranges that were too much for one list; they are asked for side by side.
CUT_RANGES = _struct(request=STRING, query=STRING, scan=LONG, lo=LONG, hi=LONG, action=STRING, is_open=BOOLEAN)

# Every page attempt that was taken in, by the scan that asked for it.
LANDED_PAGES = _struct(request=STRING, scan=LONG, page=LONG, attempt=LONG, n_items=LONG, total_count=LONG)

RESPONSE_CACHE = _struct(key=STRING, body=STRING, error=STRING, cached_at=TIME, endpoint=STRING)

STATE_TABLES = {
    "files": FILES,
    "repo_metadata": REPO_METADATA,
    "file_history": FILE_HISTORY,
    "search_hits": SEARCH_HITS,
    "content_status": CONTENT_STATUS,
    "scan_progress": SCAN_PROGRESS,
    "scan_ranges": SCAN_RANGES,
    "cut_ranges": CUT_RANGES,
    "landed_pages": LANDED_PAGES,
    "hit_ranges": _struct(url=STRING, size_min=LONG, size_max=LONG),
    "view_progress": _struct(view=STRING, version=LONG),
    "leases": _struct(stage=STRING, item=STRING, planner=STRING, ends_at=TIME),
    "asked_items": _struct(stage=STRING, planner=STRING, request_key=STRING, item=STRING, shape=STRING),
    "response_cache": RESPONSE_CACHE,
    "rejected_pages": _struct(query=STRING, line=STRING),
    "ingested_batches": _struct(stream=STRING, batch_id=LONG),
}

# Tables in folders by the values of a column; a reader of one value opens no other file.
PARTITIONS = {"response_cache": "endpoint"}

# Keys of the tables in which a row replaces an older one.
KEYS = {
    "repo_metadata": "repo_key",
    "file_history": "url",
    "content_status": "url",
    "scan_progress": "query",
    "scan_ranges": "query",
    "cut_ranges": "request",
    "view_progress": "view",
}

# Bodies of cached answers.
STORED_METADATA = StructType([f for f in REPO_METADATA.fields if f.name not in ("repo_key", "fetched_at")])
STORED_HISTORY = _struct(commits=ArrayType(COMMIT))

SEARCH_ITEM = _struct(
    sha=STRING, name=STRING, path=STRING, html_url=STRING, repository=_struct(full_name=STRING)
)

SEARCH_PAGE = _struct(
    query=STRING,
    per_page=INT,
    page=INT,
    attempt=INT,
    total_count=LONG,
    items=ArrayType(SEARCH_ITEM),
)

# A page as it is read: with its line, where that could not be read in full.
LANDED_PAGE = StructType([*SEARCH_PAGE.fields, StructField("_line", STRING)])

# Bodies of batched answers: one map entry per alias used in the request.
CONTENT_BODY = _struct(
    data=MapType(
        STRING,
        MapType(STRING, _struct(text=STRING, byteSize=LONG, isTruncated=BooleanType())),
    )
)

_NAMED = _struct(name=STRING)

METADATA_NODE = _struct(
    stargazerCount=LONG,
    forkCount=LONG,
    watchers=_struct(totalCount=LONG),
    primaryLanguage=_NAMED,
    repositoryTopics=_struct(nodes=ArrayType(_struct(topic=_NAMED))),
    createdAt=STRING,
    updatedAt=STRING,
    pushedAt=STRING,
    defaultBranchRef=_NAMED,
    licenseInfo=_struct(spdxId=STRING),
    description=STRING,
)

METADATA_BODY = _struct(data=MapType(STRING, METADATA_NODE))

COMMIT_NODE = _struct(oid=STRING, messageHeadline=STRING, committedDate=STRING, author=_NAMED)

HISTORY_BODY = _struct(
    data=MapType(
        STRING,
        MapType(STRING, MapType(STRING, _struct(nodes=ArrayType(COMMIT_NODE)))),
    )
)

# Single answers: a repository, the commits of a file.
SINGLE_REPO = _struct(
    stargazers_count=LONG,
    forks_count=LONG,
    watchers_count=LONG,
    language=STRING,
    topics=ArrayType(STRING),
    created_at=STRING,
    updated_at=STRING,
    pushed_at=STRING,
    default_branch=STRING,
    license=_struct(spdx_id=STRING),
    description=STRING,
)

SINGLE_COMMITS = ArrayType(
    _struct(sha=STRING, commit=_struct(author=_struct(name=STRING, date=STRING), message=STRING))
)
