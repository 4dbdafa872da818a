"""Batches, landed answers, outcomes and the response cache."""

from pyspark.sql import functions as F

from ..functions import keys
from ..operators import audit, batching, cache, responses, state
from ..operators.ordering import first_n
from ..sources import landed, response_log
from ..session import checkpointed, shared_folder
from .registry import query
from .scenario import (
    FAILED_BATCH,
    MISSING_REF,
    MISSING_REPO,
    content_bodies,
    history_bodies,
    table,
    view,
    with_views,
)
from .state_queries import METADATA, PARSED, REPOS

ASOF = "2024-02-01 00:00:00"
FRESH = f"cached_at > TIMESTAMP '{ASOF}' - INTERVAL 30 DAY"


def _batched(size: int, source: str = "parsed") -> str:
    return f"""batched AS (
        SELECT *, CAST(floor(rn / {size}.0) AS BIGINT) AS batch_id, CAST(rn % {size} AS INT) AS pos
        FROM (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS rn FROM {source}) p)"""


ALIASED = """aliased AS (
    SELECT *, CAST(dense_rank() OVER (PARTITION BY batch_id ORDER BY repo_first) - 1 AS INT) AS repo_no,
           CAST(dense_rank() OVER (PARTITION BY batch_id, owner, repo ORDER BY ref_first) - 1 AS INT) AS ref_no,
           CAST(row_number() OVER (PARTITION BY batch_id, owner, repo, ref ORDER BY pos) - 1 AS INT) AS file_no
    FROM (SELECT *, min(pos) OVER (PARTITION BY batch_id, owner, repo) AS repo_first,
                 min(pos) OVER (PARTITION BY batch_id, owner, repo, ref) AS ref_first FROM batched) b)"""


def _content_batches(spark, sf):
    parsed = state.parsed_files(view(spark, sf, "files").drop("text"))
    return batching.assign_batches(parsed, batching.CONTENT_BATCH)


def _history_batches(spark, sf):
    parsed = state.parsed_files(view(spark, sf, "files").drop("text"))
    return batching.assign_batches(parsed, batching.HISTORY_BATCH)


@query("assign_batches", f"{with_views('files')}, {PARSED}, {_batched(50)} SELECT url, batch_id, pos FROM batched")
def _(spark, sf):
    return _content_batches(spark, sf).select("url", "batch_id", "pos")


@query("assign_aliases", f"{with_views('files')}, {PARSED}, {_batched(5)}, {ALIASED} "
       "SELECT url, batch_id, pos, repo_no, ref_no, file_no FROM aliased")
def _(spark, sf):
    aliased = batching.assign_aliases(_history_batches(spark, sf))
    return aliased.select("url", "batch_id", "pos", "repo_no", "ref_no", "file_no")


@query("batch_requests", f"""{with_views('files')}, {PARSED}, {_batched(50)}, {ALIASED}
    SELECT batch_id, repo_no, owner, repo, string_agg(pos || '=' || ref || ':' || path, ' ' ORDER BY pos) AS items
    FROM aliased GROUP BY batch_id, repo_no, owner, repo""")
def _(spark, sf):
    grouped = batching.group_requests(batching.assign_aliases(_content_batches(spark, sf)))
    shown = F.transform(
        "items",
        lambda i: F.concat(i["pos"].cast("string"), F.lit("="), i["ref"], F.lit(":"), i["path"]),
    )
    return grouped.select("batch_id", "repo_no", "owner", "repo", F.array_join(shown, " ").alias("items"))


@query("render_batches", rf"""{with_views('files')}, {PARSED}, {_batched(50)}, {ALIASED},
    repos AS (SELECT batch_id, repo_no, '  r' || repo_no || ': repository(owner: "' || owner || '", name: "' || repo || '") {{' || chr(10)
        || string_agg('    f' || pos || ': object(expression: "' || ref || ':' || path || '") {{' || chr(10)
                      || '      ... on Blob {{ text byteSize isTruncated }}' || chr(10) || '    }}', chr(10) ORDER BY pos)
        || chr(10) || '  }}' AS block FROM aliased GROUP BY batch_id, repo_no, owner, repo)
    SELECT batch_id, 'query {{' || chr(10) || string_agg(block, chr(10) ORDER BY repo_no) || chr(10) || '}}' AS request
    FROM repos GROUP BY batch_id""")
def _(spark, sf):
    return batching.content_requests(batching.assign_aliases(_content_batches(spark, sf)))


@query("render_history_batches", rf"""{with_views('files')}, {PARSED}, {_batched(5)}, {ALIASED},
    refs AS (SELECT batch_id, repo_no, owner, repo, ref_no, '    ref' || ref_no || ': object(expression: "' || ref || '") {{' || chr(10)
        || '      ... on Commit {{' || chr(10)
        || string_agg('        f' || file_no || ': history(first: 100, path: "' || path || '") {{' || chr(10)
             || '          nodes {{ oid messageHeadline committedDate author {{ name }} }}' || chr(10) || '        }}',
             chr(10) ORDER BY file_no)
        || chr(10) || '      }}' || chr(10) || '    }}' AS block
        FROM aliased GROUP BY batch_id, repo_no, owner, repo, ref_no, ref),
    repos AS (SELECT batch_id, repo_no, '  r' || repo_no || ': repository(owner: "' || owner || '", name: "' || repo || '") {{' || chr(10)
        || string_agg(block, chr(10) ORDER BY ref_no) || chr(10) || '  }}' AS block
        FROM refs GROUP BY batch_id, repo_no, owner, repo)
    SELECT batch_id, 'query {{' || chr(10) || string_agg(block, chr(10) ORDER BY repo_no) || chr(10) || '}}' AS request
    FROM repos GROUP BY batch_id""")
def _(spark, sf):
    return batching.history_requests(batching.assign_aliases(_history_batches(spark, sf)))


@query("render_metadata_batches", rf"""{with_views('files')}, {REPOS},
    repos AS (SELECT repo_key, row_number() OVER (ORDER BY min(seq)) - 1 AS rn FROM repo_files GROUP BY repo_key),
    blocks AS (SELECT CAST(floor(rn / 50.0) AS BIGINT) AS batch_id, rn,
        '  r' || (rn % 50) || ': repository(owner: "' || split_part(repo_key, '/', 1) || '", name: "'
        || substr(repo_key, strpos(repo_key, '/') + 1) || '") {{'
        || chr(10) || '    stargazerCount' || chr(10) || '    forkCount' || chr(10) || '    watchers {{ totalCount }}'
        || chr(10) || '    primaryLanguage {{ name }}'
        || chr(10) || '    repositoryTopics(first: 20) {{ nodes {{ topic {{ name }} }} }}'
        || chr(10) || '    createdAt' || chr(10) || '    updatedAt' || chr(10) || '    pushedAt'
        || chr(10) || '    defaultBranchRef {{ name }}' || chr(10) || '    licenseInfo {{ spdxId }}'
        || chr(10) || '    description' || chr(10) || '  }}' AS block FROM repos)
    SELECT batch_id, 'query {{' || chr(10) || string_agg(block, chr(10) ORDER BY rn) || chr(10) || '}}' AS request
    FROM blocks GROUP BY batch_id""")
def _(spark, sf):
    repos = state.unique_repos(view(spark, sf, "files"))
    return batching.metadata_requests(batching.assign_batches(repos, batching.METADATA_BATCH))


ANSWERED = f"""answered AS (
    SELECT a.batch_id, a.url, a.owner, a.repo, a.ref, a.path, NOT ({FAILED_BATCH}) AS batch_ok,
           NOT ({FAILED_BATCH}) AND NOT ({MISSING_REPO}) AS repo_found,
           NOT ({FAILED_BATCH}) AND NOT ({MISSING_REPO}) AND b.blob_found IS NOT NULL AS blob_found,
           b.is_truncated, b.text, b.byte_size
    FROM batched a JOIN blobs b ON a.url = b.url)"""

CONTENT_ERROR = """CASE WHEN NOT batch_ok THEN 'error' WHEN NOT blob_found THEN 'not_found'
    WHEN is_truncated THEN 'truncated' WHEN text IS NULL THEN 'no_content' END"""


def content_round_trip(spark, sf):
    """Requests of all parsed files and the landed answers, matched again by alias.

    As in the job, the batches are written out: a request and its answer share them.
    """
    aliased = checkpointed(batching.assign_aliases(_content_batches(spark, sf)))
    return responses.content_answers(aliased, content_bodies(aliased, view(spark, sf, "blobs")))


@query("assign_aliases_join", f"""{with_views('blobs')}, {PARSED}, {_batched(50)}, {ANSWERED}
    SELECT url, batch_ok, repo_found, blob_found, blob_found AND is_truncated AS is_truncated,
           CASE WHEN blob_found THEN text END AS text, CASE WHEN blob_found THEN byte_size ELSE 0 END AS byte_size
    FROM answered""")
def _(spark, sf):
    return content_round_trip(spark, sf).select(
        "url", "batch_ok", "repo_found", "blob_found", "is_truncated", "text", "byte_size"
    )


def blob_answers(spark, sf):
    """The content answers as a landed table, without the batch around them."""
    return view(spark, sf, "blobs").select(
        "url",
        "is_truncated",
        "text",
        "byte_size",
        F.lit(True).alias("batch_ok"),
        F.col("repo_found").isNotNull().alias("repo_found"),
        F.col("blob_found").isNotNull().alias("blob_found"),
    )


BLOB_ERROR = """CASE WHEN repo_found IS NULL OR blob_found IS NULL THEN 'not_found'
    WHEN is_truncated THEN 'truncated' WHEN text IS NULL THEN 'no_content' END"""


@query("classify_content", f"{with_views('blobs')} SELECT url, {BLOB_ERROR} AS error FROM blobs")
def _(spark, sf):
    return blob_answers(spark, sf).select("url", responses.content_error().alias("error"))


@query("content_outcome", f"""{with_views('blobs')}, named AS (SELECT *, {BLOB_ERROR} AS error FROM blobs)
    SELECT url, CASE WHEN error = 'truncated' THEN 'truncated' WHEN error = 'not_found' THEN 'not_found'
                     WHEN error IS NOT NULL OR text = '' THEN 'error' ELSE 'fetched' END AS batched,
           CASE WHEN blob_found IS NULL OR repo_found IS NULL THEN 'not_found' WHEN byte_size > 20000 THEN 'error'
                WHEN text IS NOT NULL THEN 'fetched' ELSE 'not_found' END AS single
    FROM named""")
def _(spark, sf):
    """The same file asked for in a batch and alone; very long ones fail with 502 when alone."""
    named = blob_answers(spark, sf).withColumn("error", responses.content_error())
    status = (
        F.when(F.col("error") == "not_found", 404).when(F.col("byte_size") > 20000, 502).otherwise(200)
    )
    return named.select(
        "url",
        responses.batched_outcome(F.col("error"), F.col("text")).alias("batched"),
        responses.single_outcome(
            status, F.lit(None).cast("string"), F.col("text"), F.lit(False)
        ).alias("single"),
    )


@query("classify_history", f"""{with_views('commit_nodes')}, {PARSED}, {_batched(5)},
    touched AS (SELECT DISTINCT url FROM commit_nodes)
    SELECT b.url, CASE WHEN {FAILED_BATCH} THEN 'error' WHEN {MISSING_REPO} THEN 'not_found'
                       WHEN {MISSING_REF} THEN 'bad_ref' WHEN t.url IS NULL THEN 'no_history' END AS error
    FROM batched b LEFT JOIN touched t ON b.url = t.url""")
def _(spark, sf):
    return history_round_trip(spark, sf).select("url", responses.history_error().alias("error"))


def history_round_trip(spark, sf):
    aliased = checkpointed(batching.assign_aliases(_history_batches(spark, sf)))
    return responses.history_answers(aliased, history_bodies(aliased, view(spark, sf, "commit_nodes")))


@query("flatten_history", f"""{with_views('commit_nodes')}, {PARSED}, {_batched(5)},
    newest AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ord DESC) AS age FROM commit_nodes)
    SELECT b.url, left(oid, 7) AS sha, author, strftime(committed_at, '%Y-%m-%dT%H:%M:%SZ') AS date,
           left(split_part(message, chr(10), 1), 80) AS message
    FROM batched b JOIN newest n ON b.url = n.url AND n.age <= 100
    WHERE NOT ({FAILED_BATCH}) AND NOT ({MISSING_REPO}) AND NOT ({MISSING_REF})""")
def _(spark, sf):
    return audit.exploded_commits(responses.flatten_history(history_round_trip(spark, sf)))


@query("history_fields", f"""{with_views('commit_nodes')}
    SELECT url, ord, left(oid, 7) AS sha, author, committed_at AS date,
           left(split_part(message, chr(10), 1), 80) AS message FROM commit_nodes""")
def _(spark, sf):
    return responses.history_rows(view(spark, sf, "commit_nodes"))


@query("first_n_commits", f"""{with_views('commit_nodes')}
    SELECT url, ord, oid FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ord) AS rn FROM commit_nodes) c
    WHERE rn <= 50""")
def _(spark, sf):
    return first_n(view(spark, sf, "commit_nodes"), "url", "ord", 50).select("url", "ord", "oid")


def metadata_rows(spark, sf):
    """Landed one-repository answers, matched by alias."""
    bodies = view(spark, sf, "repo_bodies").withColumn("batch_id", F.col("seq"))
    asked = bodies.select("batch_id", "repo_key", "seq", F.lit(0).alias("pos"))
    return responses.metadata_answers(asked, bodies.select("batch_id", "body"))


def stored_metadata(spark, sf):
    answered = metadata_rows(spark, sf)
    repo = F.col("repo")
    return answered.filter("repo_found").select("repo_key", "seq", *responses.metadata_columns(repo))


@query("flatten_metadata", f"{with_views('repo_bodies')}, {METADATA} SELECT repo_key, stars, forks, coalesce(watchers, -1) AS watchers, language, "
       "topics, created_at, updated_at, pushed_at, default_branch, license, description FROM repo_metadata")
def _(spark, sf):
    flat = responses.flatten_metadata(metadata_rows(spark, sf))
    return flat.withColumn("topics", F.array_join("topics", ",")).withColumn(
        "watchers", F.coalesce("watchers", F.lit(-1).cast("bigint"))
    )


@query("classify_metadata", f"{with_views('repo_bodies')}, {METADATA} SELECT repo_key, "
       "CASE WHEN repo_key NOT IN (SELECT repo_key FROM repo_metadata) THEN 'not_found' END AS error FROM repo_bodies")
def _(spark, sf):
    return metadata_rows(spark, sf).select("repo_key", responses.metadata_error().alias("error"))


# --- search pages ------------------------------------------------------------------------


def landed_pages(spark, sf):
    """Landed search pages: one row per attempt, its items in order."""
    item = F.struct(
        "seq",
        F.struct(
            "sha",
            F.substring_index("url", "/", -1).alias("name"),
            F.substring(F.col("url"), 20, 2**31 - 1).alias("path"),
            F.col("url").alias("html_url"),
            F.struct(F.col("query").alias("full_name")).alias("repository"),
        ).alias("item"),
    )
    return (
        view(spark, sf, "page_attempts")
        .groupBy("query", "page", "attempt")
        .agg(F.max("total_count").alias("total_count"), F.array_sort(F.collect_list(item)).alias("found"))
        .select(
            "query", F.lit(100).alias("per_page"), "page", "attempt", "total_count",
            F.transform("found", lambda f: f["item"]).alias("items"),
        )
    )


@query("search_pages_scan", f"""{with_views('page_attempts')}
    SELECT query, page, attempt, total_count, CAST(row_number() OVER (PARTITION BY query, page, attempt ORDER BY seq) - 1 AS INT)
           AS item_no, url, sha, split_part(url, '/', -1) AS name, substr(url, 20) AS path, query AS full_name
    FROM page_attempts""")
def _(spark, sf):
    """Write the pages as JSON lines and read them back with the declared schema."""
    path = shared_folder(spark)
    landed_pages(spark, sf).write.json(path)
    return responses.search_items(landed.read_search_pages(spark, path))


@query("assemble_search_pages", f"""{with_views('page_attempts', recursive=True)},
    per_page AS (SELECT query, page, min(attempt) AS attempt, count(*) AS n, max(total_count) AS total
                 FROM page_attempts WHERE page <= 10 AND attempt <= 3 GROUP BY query, page),
    walk AS (SELECT query, page, attempt, n, total, CAST(0 AS BIGINT) AS prior FROM per_page
             WHERE page = 1 AND NOT (attempt > 1 AND least(total, 10) <= 0)
             UNION ALL SELECT p.query, p.page, p.attempt, p.n, w.total, CAST(w.prior + w.n AS BIGINT)
             FROM walk w JOIN per_page p ON p.query = w.query AND p.page = w.page + 1
             WHERE NOT (p.attempt > 1 AND w.prior + w.n >= least(w.total, p.page * 10)))
    SELECT a.query, a.page, a.url, w.query IS NOT NULL AS in_walk FROM page_attempts a
    LEFT JOIN walk w ON a.query = w.query AND a.page = w.page AND a.attempt = w.attempt""")
def _(spark, sf):
    items = view(spark, sf, "page_attempts")
    return responses.assemble_pages(items, page_size=10).select("query", "page", "url", "in_walk")


# --- cache -------------------------------------------------------------------------------


def cache_table(spark, sf):
    """The scenario's cache under its real keys."""
    entries = state.parsed_files(view(spark, sf, "cache"))
    key = keys.content_key(F.col("owner"), F.col("repo"), F.col("ref"), F.col("path"))
    return entries.select(key.alias("key"), "body", "error", "cached_at")


def content_keys(spark, sf):
    parsed = state.parsed_files(view(spark, sf, "files").select("url"))
    key = keys.content_key(F.col("owner"), F.col("repo"), F.col("ref"), F.col("path"))
    return parsed.select("url", key.alias("key"))


def _lookup_check(usable: str) -> str:
    return f"""{with_views('cache')}, {PARSED}
        SELECT p.url, c.body, c.error, c.url IS NOT NULL AS is_hit
        FROM parsed p LEFT JOIN (SELECT * FROM cache WHERE {usable}) c ON p.url = c.url"""


def _looked_up(spark, sf, **flags):
    found = cache.lookup(content_keys(spark, sf), cache_table(spark, sf), ASOF, **flags)
    return found.select("url", "body", "error", "is_hit")


@query("cache_lookup", _lookup_check(FRESH))
def _(spark, sf):
    return _looked_up(spark, sf)


@query("cache_ttl", f"{with_views('cache')} SELECT url, {FRESH} AS is_fresh FROM cache")
def _(spark, sf):
    return view(spark, sf, "cache").select("url", cache.is_fresh(F.col("cached_at"), ASOF).alias("is_fresh"))


@query("cache_skip_read", _lookup_check("1 = 0"))
def _(spark, sf):
    return _looked_up(spark, sf, skip_read=True)


@query("retry_errors", _lookup_check(f"{FRESH} AND error IS NULL"))
def _(spark, sf):
    return _looked_up(spark, sf, retry_errors=True)


@query("cache_admit", f"""{with_views('request_log', 'page_attempts', 'blobs')},
    named AS (SELECT *, {BLOB_ERROR} AS error FROM blobs)
    SELECT 'call' AS kind, CAST(request_id AS VARCHAR) AS id,
           method = 'GET' AND status BETWEEN 200 AND 299 AS admitted FROM request_log
    UNION ALL SELECT 'batch', CAST(request_id AS VARCHAR), body <> '' FROM request_log
    UNION ALL SELECT 'search', query || '/' || page || '/' || attempt,
           count(CASE WHEN attempt <= 3 THEN url END) > 0 OR page = 1
           FROM page_attempts GROUP BY query, page, attempt
    UNION ALL SELECT 'content', url, error IS NULL OR error <> 'truncated' FROM named""")
def _(spark, sf):
    log = view(spark, sf, "request_log")
    call = log.select(
        F.lit("call").alias("kind"),
        F.col("request_id").cast("string").alias("id"),
        cache.admit_call(F.col("method"), F.col("status")).alias("admitted"),
    )
    data = F.try_variant_get(F.try_parse_json("body"), "$.k", "int")
    batch = log.select(F.lit("batch"), F.col("request_id").cast("string"), cache.admit_batch(data))
    # A page given up on (fourth try) holds nothing.
    pages = view(spark, sf, "page_attempts").groupBy("query", "page", "attempt").agg(
        F.count(F.when(F.col("attempt") <= 3, F.col("url"))).alias("n")
    )
    search = pages.select(
        F.lit("search"),
        F.concat_ws("/", "query", F.col("page").cast("string"), F.col("attempt").cast("string")),
        cache.admit_search(F.lit(200), F.col("n"), F.col("page")),
    )
    content = blob_answers(spark, sf).select(
        F.lit("content"), "url", cache.admit_content(responses.content_error())
    )
    return call.union(batch).union(search).union(content)


@query("cache_write", f"""{with_views('cache', 'status_updates')},
    latest AS (SELECT url, arg_max(status, seq) AS body FROM status_updates GROUP BY url)
    SELECT url AS key, body, CAST(NULL AS VARCHAR) AS error FROM latest
    UNION ALL SELECT url, body, error FROM cache WHERE url NOT IN (SELECT url FROM latest)""")
def _(spark, sf):
    current = view(spark, sf, "cache").withColumnRenamed("url", "key")
    updates = view(spark, sf, "status_updates").select("seq", F.col("url").alias("key"), F.col("status").alias("body"))
    return cache.write_entries(current, updates).select("key", "body", "error")


@query("cache_scan", """
    SELECT md5(CAST(doc_id AS VARCHAR)) AS key, CASE WHEN doc_id % 7 = 0 THEN 'not_found' END AS error,
           CAST(length(text) AS BIGINT) AS n_chars FROM documents WHERE lang <> 'es'""")
def _(spark, sf):
    """Cache files of all documents; the Spanish ones are empty, cut short or not text at all."""
    docs = table(spark, sf, "documents")
    error = F.when(F.col("doc_id") % 7 == 0, F.lit("not_found"))
    good = F.to_json(F.struct(error.alias("error"), F.col("text").alias("content")))
    broken = (
        F.when(F.length("text") % 3 == 0, F.lit(b""))
        .when(F.length("text") % 3 == 1, F.lit(b"\x00\x01\x02\xff\xfe"))
        .otherwise(F.encode(F.left(good, F.lit(12)), "UTF-8"))
    )
    files = docs.select(
        F.concat(F.lit("file:/cache/"), F.md5(F.col("doc_id").cast("string")), F.lit(".json")).alias("path"),
        F.when(F.col("lang") == "es", broken).otherwise(F.encode(good, "UTF-8")).alias("content"),
        F.lit(ASOF).cast("timestamp").alias("modificationTime"),
    )
    content = F.get_json_object("body", "$.content")
    return landed.cache_rows(files).select("key", "error", F.char_length(content).cast("bigint").alias("n_chars"))


# --- logs --------------------------------------------------------------------------------


@query("envelope", f"""{with_views('request_log')}
    SELECT request_id, status, CASE WHEN body = '' THEN -1 ELSE CAST(body ->> '$.k' AS BIGINT) END AS k,
           CASE WHEN body = '' THEN '{{}}' ELSE replace(body, ' ', '') END AS body, retry_after AS etag,
           CAST(NULL AS VARCHAR) AS link FROM request_log""")
def _(spark, sf):
    log = view(spark, sf, "request_log").select(
        "request_id", "status", "body", F.col("retry_after").alias("etag"), F.lit(None).cast("string").alias("link")
    )
    kept = responses.envelope(log)
    return kept.select(
        "request_id", "status", F.coalesce(F.variant_get("body", "$.k", "bigint"), F.lit(-1)).alias("k"), F.to_json("body").alias("body"),
        "etag", "link",
    )


@query("envelope_paths", f"""{with_views('repo_bodies')}
    SELECT repo_key, seq, coalesce(CAST(body ->> '$.data.r0.stargazerCount' AS BIGINT), -1) AS stars,
           coalesce(CAST(body ->> '$.data.r0.watchers.totalCount' AS BIGINT), -1) AS watchers,
           coalesce(body ->> '$.data.r0.primaryLanguage.name', '') AS language, coalesce(body ->> '$.data.r0.absent', '') AS absent
    FROM repo_bodies""")
def _(spark, sf):
    """Typed paths of bodies that are written shredded; the other fields stay unread."""
    folder = shared_folder(spark)
    response_log.write_log(view(spark, sf, "repo_bodies"), folder)
    paths = {
        "stars": ("$.data.r0.stargazerCount", "bigint"), "watchers": ("$.data.r0.watchers.totalCount", "bigint"),
        "language": ("$.data.r0.primaryLanguage.name", "string"), "absent": ("$.data.r0.absent", "string"),
    }
    found = response_log.read_paths(spark, folder, paths, "repo_key", "seq")
    return found.fillna(-1, ["stars", "watchers"]).fillna("", ["language", "absent"])


@query("response_disposition", f"""{with_views('request_log')}
    SELECT request_id,
           CASE WHEN status = 429 OR (status = 403 AND contains(lower(body_text), 'rate limit')) THEN 'rate_limited'
                WHEN status >= 500 THEN 'retryable' WHEN status < 300 THEN 'success' ELSE 'terminal' END AS single,
           CASE WHEN status = 200 THEN 'success' WHEN status IN (403, 429) THEN 'rate_limited'
                WHEN status >= 500 THEN 'retryable' ELSE 'terminal' END AS batch,
           TRY_CAST(retry_after AS DOUBLE) AS wait_seconds FROM request_log""")
def _(spark, sf):
    return view(spark, sf, "request_log").select(
        "request_id",
        responses.rest_disposition(F.col("status"), F.col("body_text")).alias("single"),
        responses.batch_disposition(F.col("status")).alias("batch"),
        responses.retry_after_seconds(F.col("retry_after")).alias("wait_seconds"),
    )


@query("run_stats", f"""{with_views('blobs', 'cache')}, named AS (SELECT *, {BLOB_ERROR} AS error FROM blobs),
    outcomes AS (SELECT n.url, c.url IS NOT NULL AS is_hit,
        CASE WHEN error = 'truncated' AND byte_size > 20000 THEN 'not_found' WHEN error = 'truncated' THEN 'truncated_rest'
             WHEN error = 'not_found' THEN 'not_found' WHEN error IS NOT NULL OR text = '' THEN 'error'
             ELSE 'fetched' END AS outcome
        FROM named n LEFT JOIN (SELECT url FROM cache WHERE {FRESH}) c ON n.url = c.url)
    SELECT count(*) FILTER (outcome = 'fetched') AS fetched, CAST(0 AS BIGINT) AS skipped,
           count(*) FILTER (outcome = 'not_found') AS not_found, count(*) FILTER (outcome = 'error') AS errors,
           count(*) FILTER (outcome = 'truncated_rest') AS truncated_rest, CAST(0 AS BIGINT) AS pending,
           count(*) FILTER (is_hit) AS cache_hits
    FROM outcomes""")
def _(spark, sf):
    entries = cache.readable_entries(view(spark, sf, "cache"), ASOF).select("url", F.lit(True).alias("_hit"))
    named = blob_answers(spark, sf).withColumn("error", responses.content_error())
    batched = responses.batched_outcome(F.col("error"), F.col("text"))
    alone = F.when(F.col("byte_size") > 20000, "not_found").otherwise("truncated_rest")
    outcomes = named.withColumn("outcome", F.when(batched == "truncated", alone).otherwise(batched))
    marked = outcomes.join(entries, "url", "left").withColumn("is_hit", F.coalesce("_hit", F.lit(False)))
    return audit.outcome_counts(marked)


@query("request_telemetry", f"""{with_views('request_log')}
    SELECT count(*) AS queries, count(*) FILTER (status >= 500) AS retries,
           count(*) FILTER (status IN (403, 429)) AS rate_limit_hits, round(avg(elapsed_ms), 4) AS avg_ms,
           round(count(*) * 1e6 / (epoch_us(max(started_at)) - epoch_us(min(started_at))), 6) AS queries_per_sec
    FROM request_log""")
def _(spark, sf):
    counted = audit.request_telemetry(view(spark, sf, "request_log"))
    return counted.withColumn("avg_ms", F.round("avg_ms", 4)).withColumn(
        "queries_per_sec", F.round("queries_per_sec", 6)
    )


@query("history_summary", f"""{with_views('commit_nodes')}
    SELECT url, min(committed_at) AS first_commit, max(committed_at) AS last_commit,
           count(DISTINCT author) AS n_authors, count(*) AS n_commits FROM commit_nodes GROUP BY url""")
def _(spark, sf):
    nodes = view(spark, sf, "commit_nodes").select("url", F.col("committed_at").alias("date"), "author")
    return audit.history_summary(nodes)
