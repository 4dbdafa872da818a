"""A code-collection scenario over the test tables.

Each view is one SELECT that Spark and DuckDB both read, so the checks of both sides start
from the same rows. Views use whole tables; the only filters are on content (language,
label), where the scenario itself needs two collections that differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as text_functions
from ..operators.batching import file_alias, ref_alias, repo_alias
from ..operators.ordering import first_n

# Declared, so that no job has to look into the files first.
TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "conversations": "conv_id long, turn long, role string, text string",
    "pages": "page_id long, url string, html string",
}

VIEWS = {
    # One file per document: other hosts, folders, upper-case hosts and stub URLs occur.
    "files": """
        SELECT doc_id AS seq,
               CASE WHEN doc_id % 23 = 0 THEN 'https://gitlab.com/'
                    WHEN doc_id % 31 = 0 THEN 'https://GitHub.com/'
                    ELSE 'https://github.com/' END
               || CASE WHEN doc_id % 37 = 0 THEN 'only' || CAST(doc_id AS STRING)
                       WHEN doc_id % 41 = 0 THEN lang || '/stub' || CAST(doc_id AS STRING)
                       ELSE lang || '/r' || CAST(CAST(floor(doc_id / 100.0) AS BIGINT) AS STRING)
                            || CASE WHEN doc_id % 29 = 0 THEN '/tree/' ELSE '/blob/' END
                            || CASE WHEN doc_id % 3 = 0 THEN 'dev' ELSE 'main' END
                            || '/' || source || '/doc' || CAST(doc_id AS STRING) || '.md' END AS url,
               md5(text) AS sha, n_chars AS size_bytes, source AS query, lang, text
        FROM documents""",
    # A second delivery: known URLs with another sha, and new URLs delivered twice.
    "incoming": """
        SELECT seq + 1000000000000 AS seq, url, md5(url) AS sha FROM files
        UNION ALL
        SELECT seq + 2000000000000 AS seq, url || '.new' AS url, sha FROM files
        UNION ALL
        SELECT seq + 3000000000000 AS seq, url || '.new' AS url, md5(url) AS sha FROM files""",
    # Labelled files are done.
    "content_status": """
        SELECT f.url, CASE WHEN l.toxic = 1 THEN 'error' WHEN l.quality = 0 THEN 'not_found'
                           ELSE 'fetched' END AS status
        FROM files f JOIN labels l ON f.seq = l.doc_id""",
    # Many updates per key, in event order.
    "status_updates": """
        SELECT e.event_id AS seq, f.url,
               CASE e.event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'not_found'
                                 ELSE 'fetched' END AS status
        FROM events e JOIN files f ON e.user_id = f.seq""",
    # Every file in a narrow range; English ones in a wider range around it, too.
    "hits": """
        SELECT url, query, CAST(floor(size_bytes / 1000.0) * 1000 AS BIGINT) AS size_min,
               CAST(floor(size_bytes / 1000.0) * 1000 + 999 AS BIGINT) AS size_max FROM files
        UNION ALL
        SELECT url, query, CAST(floor(size_bytes / 4000.0) * 4000 AS BIGINT) AS size_min,
               CAST(floor(size_bytes / 4000.0) * 4000 + 3999 AS BIGINT) AS size_max
        FROM files WHERE lang = 'en'""",
    # What the service claims per query and size: it only counts English files.
    "estimates": """
        SELECT query, size_bytes AS size, count(*) AS est FROM files WHERE lang = 'en'
        GROUP BY query, size_bytes""",
    # Landed metadata answers, one repository each.
    "repo_bodies": """
        SELECT repo_key, n AS seq,
               CASE WHEN n % 6 = 0 THEN '{"data":{"r0":null}}' ELSE
               '{"data":{"r0":{"stargazerCount":' || CAST(n AS STRING)
               || ',"forkCount":' || CAST(n % 7 AS STRING)
               || ',"watchers":' || CASE WHEN n % 4 = 0 THEN 'null'
                                         ELSE '{"totalCount":' || CAST(n % 9 AS STRING) || '}' END
               || ',"primaryLanguage":' || CASE WHEN n % 5 = 0 THEN 'null' ELSE '{"name":"Python"}' END
               || ',"repositoryTopics":{"nodes":[{"topic":{"name":"ai"}},{"topic":null},{"topic":{"name":"t'
               || CAST(n % 3 AS STRING) || '"}}]}'
               || ',"createdAt":"2024-01-01T00:00:00Z","updatedAt":null,"pushedAt":null'
               || ',"defaultBranchRef":{"name":"main"},"licenseInfo":null,"description":"repo"}}}' END AS body
        FROM (SELECT lang || '/r' || CAST(CAST(floor(doc_id / 100.0) AS BIGINT) AS STRING) AS repo_key,
                     max(doc_id) AS n
              FROM documents
              GROUP BY lang || '/r' || CAST(CAST(floor(doc_id / 100.0) AS BIGINT) AS STRING)) x""",
    # One content answer per file.
    "blobs": """
        SELECT seq, url, CASE WHEN seq % 17 = 0 THEN NULL ELSE 1 END AS repo_found,
               CASE WHEN seq % 13 = 0 THEN NULL ELSE 1 END AS blob_found,
               size_bytes > 10000 AS is_truncated,
               CASE WHEN seq % 11 = 0 THEN NULL WHEN seq % 19 = 0 THEN '' ELSE text END AS text,
               size_bytes AS byte_size
        FROM files""",
    # Commits of files, by the user who made them.
    "commit_nodes": """
        SELECT f.url, e.event_id AS ord, md5(CAST(e.event_id AS STRING)) AS oid,
               CASE WHEN e.event_id % 10 = 0 THEN NULL ELSE e.event_type END AS author,
               e.ts AS committed_at, e.event_type || ' ' || e.props || chr(10) || f.query AS message
        FROM events e JOIN files f ON e.user_id = f.seq""",
    # Cache entries for labelled files; long ones expired, poor ones are errors.
    "cache": """
        SELECT f.url, CASE WHEN l.quality = 0 THEN 'not_found' ELSE NULL END AS error,
               f.sha AS body,
               CASE WHEN f.size_bytes > 3000 THEN CAST('2023-12-01 00:00:00' AS TIMESTAMP)
                    ELSE CAST('2024-01-20 00:00:00' AS TIMESTAMP) END AS cached_at
        FROM files f JOIN labels l ON f.seq = l.doc_id""",
    # Page attempts of each search, about ten items a page. Searches ending in 1 succeed at the
    # second try; those ending in 7 lose page 3 for good.
    "page_attempts": """
        SELECT p.query, p.page, CASE WHEN p.query LIKE '%1' THEN 2
                                     WHEN p.query LIKE '%7' AND p.page = 3 THEN 4 ELSE 1 END AS attempt,
               p.seq, p.url, p.sha, t.total_count
        FROM (SELECT seq, query, url, sha, CAST(floor(seq / 200.0) AS INT) + 1 AS page FROM files) p
        JOIN (SELECT query, count(*) AS total_count FROM files GROUP BY query) t ON p.query = t.query""",
    # Links of a repository: relative chains through the turns, absolute ones now and then.
    "links": """
        SELECT 'o/r' || CAST(conv_id AS STRING) AS repo_key, 'd/f' || CAST(turn AS STRING) AS path,
               CASE WHEN turn = 0 THEN NULL WHEN turn % 4 = 3 THEN '/abs'
                    ELSE '../d/./f' || CAST(turn - 1 AS STRING) END AS target
        FROM conversations""",
    # Answers over time.
    "request_log": """
        SELECT event_id AS request_id, ts AS started_at, value AS elapsed_ms,
               CASE event_type WHEN 'error' THEN 502 WHEN 'view' THEN 429 WHEN 'signup' THEN 403
                               WHEN 'click' THEN 404 ELSE 200 END AS status,
               CASE WHEN event_id % 2 = 0 THEN 'GET' ELSE 'POST' END AS method,
               CASE WHEN event_id % 3 = 0 THEN 'API Rate Limit hit' ELSE '' END AS body_text,
               CASE event_id % 3 WHEN 0 THEN '30' WHEN 1 THEN 'soon' ELSE NULL END AS retry_after,
               CASE WHEN event_id % 7 = 0 THEN '' ELSE props END AS body
        FROM events""",
    # Two collections: one saw English files only, the other all but toxic ones.
    "run_a": "SELECT query AS test, url FROM files WHERE lang = 'en'",
    "run_b": """
        SELECT f.query AS test, f.url FROM files f LEFT JOIN labels l ON f.seq = l.doc_id
        WHERE coalesce(l.toxic, 0) = 0""",
    # The count the service reports per test: short files only.
    "reported": """
        SELECT query AS test, CAST(sum(CASE WHEN size_bytes < 1000 THEN 1 ELSE 0 END) AS BIGINT) AS api
        FROM files GROUP BY query""",
    # The same collections by smaller tests, and claims of very different sizes; some tests have none.
    "small_a": "SELECT query || '/' || CAST(seq % 7 AS STRING) AS test, url FROM files WHERE lang = 'en'",
    "small_b": """
        SELECT f.query || '/' || CAST(f.seq % 7 AS STRING) AS test, f.url
        FROM files f LEFT JOIN labels l ON f.seq = l.doc_id WHERE coalesce(l.toxic, 0) = 0""",
    "claimed": """
        SELECT query || '/' || CAST(seq % 7 AS STRING) AS test,
               CAST(sum(CASE seq % 7 WHEN 0 THEN 1 WHEN 1 THEN 5 WHEN 2 THEN 20 WHEN 3 THEN 200 WHEN 4 THEN 2000
                                     WHEN 5 THEN 1 END) AS BIGINT) AS api
        FROM files GROUP BY query || '/' || CAST(seq % 7 AS STRING)""",
}



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A scenario view as a DataFrame."""
    for source in TABLES:
        if source in VIEWS[name] or source == "documents":
            table(spark, sf_dir, source).createOrReplaceTempView(source)
    if name != "files":
        spark.sql(VIEWS["files"]).createOrReplaceTempView("files")
    return spark.sql(VIEWS[name])


def with_views(*names: str, recursive: bool = False) -> str:
    """WITH clause that defines the named views (files first) for a DuckDB check."""
    wanted = ["files", *[n for n in VIEWS if n in names and n != "files"]]
    parts = ", ".join(f"{name} AS ({VIEWS[name]})" for name in wanted)
    return ("WITH RECURSIVE " if recursive else "WITH ") + parts


# --- answers of the service ----------------------------------------------------------------

# Repositories, refs and batches the service fails on, as conditions both sides can read.
MISSING_REPO = "repo IN ('r3', 'r5')"
MISSING_REF = "repo = 'r4' AND ref = 'dev'"
FAILED_BATCH = "batch_id % 11 = 10"


def _body(data) -> Column:
    answered = F.to_json(F.struct(data.alias("data")), {"ignoreNullFields": "false"})
    failed = '{"data":null,"errors":[{"type":"RATE_LIMITED"}]}'
    return F.when(F.expr(FAILED_BATCH), F.lit(failed)).otherwise(answered)


def _entries(alias, value) -> Column:
    return F.map_from_entries(F.collect_list(F.struct(alias.alias("k"), value.alias("v"))))


def content_bodies(aliased: DataFrame, blobs: DataFrame) -> DataFrame:
    """Landed answers to content batches: batch_id, body. Groups stay within one batch."""
    blob = F.when(
        F.col("blob_found").isNotNull(),
        F.struct("text", F.col("byte_size").alias("byteSize"), F.col("is_truncated").alias("isTruncated")),
    )
    items = aliased.join(blobs.select("url", "blob_found", "text", "byte_size", "is_truncated"), "url")
    repos = items.groupBy("batch_id", "repo_no", "repo").agg(_entries(file_alias(F.col("pos")), blob).alias("files"))
    found = F.when(~F.expr(MISSING_REPO), F.col("files"))
    batches = repos.groupBy("batch_id").agg(_entries(repo_alias(F.col("repo_no")), found).alias("data"))
    return batches.select("batch_id", _body(F.col("data")).alias("body"))


def single_answers(blobs: DataFrame) -> DataFrame:
    """Landed single-file answers for the truncated files; very long ones are gone."""
    gone = F.col("byte_size") > 20000
    return blobs.filter("is_truncated").select(
        "url",
        F.when(gone, 404).otherwise(200).alias("status"),
        F.lit(None).cast("string").alias("error"),
        F.when(~gone, text_functions.encoded_text(F.col("text"))).alias("content"),
        F.lit(False).alias("is_folder"),
    )


def metadata_bodies(batched: DataFrame, repo_bodies: DataFrame) -> DataFrame:
    """Landed answers to metadata batches, put together from the one-repository bodies."""
    known = repo_bodies.select("repo_key", F.regexp_extract("body", r'^\{"data":\{"r0":(.*)\}\}$', 1).alias("repo"))
    part = F.concat(F.lit('"'), repo_alias(F.col("pos")), F.lit('":'), F.coalesce("repo", F.lit("null")))
    return (
        batched.join(known, "repo_key", "left")
        .groupBy("batch_id")
        .agg(F.array_join(F.collect_list(part), ",").alias("parts"))
        .select("batch_id", F.concat(F.lit('{"data":{'), F.col("parts"), F.lit("}}")).alias("body"))
    )


def history_bodies(aliased: DataFrame, commit_nodes: DataFrame) -> DataFrame:
    """Landed answers to history batches; files nobody touched have no history."""
    node = F.struct(
        "ord",
        F.struct(
            "oid",
            F.substring_index("message", "\n", 1).alias("messageHeadline"),
            F.date_format("committed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("committedDate"),
            F.when(F.col("author").isNotNull(), F.struct(F.col("author").alias("name"))).alias("author"),
        ).alias("node"),
    )
    # The service returns the newest 100 commits of a file.
    newest = first_n(commit_nodes.withColumn("_age", -F.col("ord")), "url", "_age", 100)
    ordered = F.sort_array(F.collect_list(node), asc=False)
    nodes = newest.groupBy("url").agg(F.transform(ordered, lambda n: n["node"]).alias("nodes"))
    items = aliased.join(nodes, "url", "left")
    history = F.when(F.col("nodes").isNotNull(), F.struct("nodes"))
    refs = items.groupBy("batch_id", "repo_no", "repo", "ref_no", "ref").agg(
        _entries(file_alias(F.col("file_no")), history).alias("files")
    )
    ref_found = F.when(~F.expr(MISSING_REF), F.col("files"))
    repos = refs.groupBy("batch_id", "repo_no", "repo").agg(
        _entries(ref_alias(F.col("ref_no")), ref_found).alias("refs")
    )
    found = F.when(~F.expr(MISSING_REPO), F.col("refs"))
    batches = repos.groupBy("batch_id").agg(_entries(repo_alias(F.col("repo_no")), found).alias("data"))
    return batches.select("batch_id", _body(F.col("data")).alias("body"))
