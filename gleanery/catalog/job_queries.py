"""The composed jobs and the resumable ingest, run end to end on the scenario."""

from pyspark.sql import functions as F

from ..functions import keys, text, urls
from ..operators import audit, paths, state
from ..plans import calls, jobs, singles
from ..sources.content_tree import write_content_table
from ..sources.state_store import StateStore
from ..streaming.ingest import ingest_pages, ingested_files
from . import scenario
from ..session import checkpointed, shared_folder
from .registry import query
from .response_queries import ANSWERED, ASOF, CONTENT_ERROR, _batched, landed_pages
from .scan_queries import CLAIMED, LIMITS, OVERLAP, _fetched, _walk
from .scenario import FAILED_BATCH, MISSING_REF, MISSING_REPO, view, with_views
from .state_queries import METADATA, PARSED, REPOS


def _store(spark, sf) -> StateStore:
    """A new state that already holds the scenario's files."""
    store = StateStore(spark, shared_folder(spark))
    store.create()
    store.append("files", view(spark, sf, "files"))
    return store


def _landed(plan, bodies):
    """Answers as they land: by the key of their request."""
    return plan.requests.select("batch_id", "request_key").join(bodies, "batch_id").select("request_key", "body")


@query("job_collect_paths", f"""{with_views('estimates', recursive=True)}, {_walk(CLAIMED)}, {_fetched()},
    found AS (SELECT url, min(seq) AS item_seq FROM fetched WHERE action = 'collect' GROUP BY url)
    SELECT f.url, f.sha, row_number() OVER (ORDER BY item_seq) - 1 AS seq
    FROM found JOIN files f ON f.seq = item_seq""")
def _(spark, sf):
    """Scan twice: the second run finds every query finished and changes nothing."""
    store = StateStore(spark, shared_folder(spark))
    store.create()
    items = view(spark, sf, "files").select("seq", "query", "url", "sha", "size_bytes")
    for _ in range(2):
        jobs.collect_paths(store, items, ASOF, view(spark, sf, "estimates"), LIMITS)
    return store.read("files").select("url", "sha", "seq")


PROBED = """probed AS (
    SELECT r.query || '#' || r.chunk AS query, r.lo, least(r.lo + r.chunk - 1, 1000000) AS hi, r.chunk, r.empties,
           CASE WHEN r.chunk <> 7 THEN (SELECT count(*) FROM files f WHERE f.query = r.query
               AND f.size_bytes BETWEEN r.lo AND least(r.lo + r.chunk - 1, 1000000)) END AS total
    FROM (SELECT DISTINCT query, c.chunk, c.lo, c.empties FROM files, (VALUES (1, 0, 9), (7, 0, 3), (2000, 0, 0), (3000, 1, 2),
          (1000000, 500, 4), (1000, 999999, 0), (5, 900000, 2)) c(chunk, lo, empties)) r),
acted AS (
    SELECT *, CASE WHEN total IS NULL THEN 'pending' WHEN total = 0 THEN 'empty' WHEN total >= 20 AND lo < hi THEN 'narrow'
                   WHEN total >= 20 THEN 'over_full' ELSE 'collected' END AS action FROM probed)"""


@query("path_next_ranges", f"""{with_views('files')}, {PROBED}
    SELECT query, action,
           CASE WHEN action IN ('pending', 'narrow') OR (action = 'empty' AND empties >= 9) THEN lo ELSE hi + 1 END::BIGINT AS next_lo,
           CASE WHEN action = 'narrow' THEN greatest(chunk // 2, 1)
                WHEN action = 'pending' OR (action = 'empty' AND empties >= 9) THEN chunk ELSE least(chunk * 2, 1000000) END::BIGINT AS next_chunk,
           CASE action WHEN 'empty' THEN empties + 1 WHEN 'pending' THEN empties ELSE 0 END::BIGINT AS next_empties,
           (action = 'empty' AND empties >= 9) OR (action IN ('empty', 'collected', 'over_full') AND hi >= 1000000) AS completed
    FROM acted""")
def _(spark, sf):
    """The next range of every query of the table, from seven places of a scan; one place has no answer yet."""
    files = view(spark, sf, "files")
    places = [(1, 0, 9), (7, 0, 3), (2000, 0, 0), (3000, 1, 2), (1_000_000, 500, 4), (1000, 999_999, 0), (5, 900_000, 2)]
    place = F.explode(F.array(*[
        F.struct(*[F.lit(v).cast("bigint").alias(n) for n, v in zip(("chunk", "lo", "empties"), p)]) for p in places
    ]))
    ranges = files.select("query").distinct().select("query", place.alias("p")).select("query", "p.*").withColumn(
        "hi", F.least(F.col("lo") + F.col("chunk") - 1, F.lit(paths.MAX_SIZE).cast("bigint"))
    )
    sized = files.groupBy("query", "size_bytes").agg(F.count("*").alias("n"))
    inside = (ranges["query"] == sized["query"]) & sized["size_bytes"].between(F.col("lo"), F.col("hi"))
    counted = ranges.join(sized, inside, "left").groupBy(ranges["query"], "lo", "hi", "chunk", "empties").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_items")
    )
    probed = counted.withColumn("total_count", F.when(F.col("chunk") != 7, F.col("n_items"))).withColumn(
        "query", F.concat_ws("#", "query", F.col("chunk").cast("string"))
    )
    moved = paths.next_ranges(probed, limit=20)
    return moved.select("query", "action", "next_lo", "next_chunk", "next_empties", "completed")


@query("record_paths", f"""{with_views('files')}
    SELECT f.url, min(f.sha) AS sha, count(*) AS n_hits, 0::BIGINT AS size_min, 999999::BIGINT AS size_max FROM files f GROUP BY f.url""")
def _(spark, sf):
    """Land the whole list of every query for its first range: all of it is stored, full or not."""
    store = StateStore(spark, shared_folder(spark))
    store.create()
    files = view(spark, sf, "files")
    plan = jobs.plan_paths(store, files, first_chunk=1_000_000)
    items = files.join(plan.select("query", "request"), "query").select(F.col("request").alias("query"), "url", "sha")
    probes = items.groupBy(F.col("query").alias("request")).agg(F.count("*").alias("total_count"))
    jobs.record_paths(store, plan, probes, items, ASOF)
    hits = store.read("search_hits").groupBy("url", "size_min", "size_max").agg(F.count("*").alias("n_hits"))
    return store.read("files").select("url", "sha").join(hits, "url").select("url", "sha", "n_hits", "size_min", "size_max")


JOB_PENDING = """pending AS (
    SELECT p.* FROM parsed p WHERE NOT EXISTS (SELECT 1 FROM content_status c WHERE c.url = p.url)
    AND p.lang <> 'de')"""


JOB_CONTENT = f"""{with_views('content_status', 'blobs')}, {PARSED}, {JOB_PENDING},
    asked AS (SELECT * FROM pending WHERE lang <> 'fr'), {_batched(50, "asked")}, {ANSWERED},
    named AS (SELECT url, text, byte_size, {CONTENT_ERROR} AS error FROM answered WHERE batch_ok),
    fresh AS (SELECT url, CASE WHEN error = 'truncated' AND byte_size > 20000 THEN 'not_found'
                               WHEN error = 'truncated' AND text IS NULL THEN 'not_found'
                               WHEN error = 'truncated' THEN 'fetched'
                               WHEN error = 'not_found' THEN 'not_found'
                               WHEN error IS NOT NULL OR text = '' THEN 'error' ELSE 'fetched' END AS status FROM named),
    on_disk AS (SELECT url, 'fetched' AS status FROM parsed p WHERE lang = 'de'
                AND NOT EXISTS (SELECT 1 FROM content_status c WHERE c.url = p.url)),
    cached AS (SELECT url, 'fetched' AS status FROM pending WHERE lang = 'fr')
    SELECT url, status FROM content_status UNION ALL SELECT url, status FROM fresh
    UNION ALL SELECT url, status FROM on_disk UNION ALL SELECT url, status FROM cached"""


@query("job_content", JOB_CONTENT)
def _(spark, sf):
    """German files are on disk, French ones cached; the rest is asked for in batches."""
    return _content_run(spark, sf)


@query("job_content_killed", JOB_CONTENT)
def _(spark, sf):
    """The same run, killed with its first stage written and its commit half filled, and repeated under its name."""
    return _content_run(spark, sf, killed=True)


def _content_run(spark, sf, killed=False):
    store = _store(spark, sf)
    store.append("content_status", view(spark, sf, "content_status"))
    parsed = state.parsed_files(view(spark, sf, "files"))
    place = [F.col(c) for c in ("owner", "repo", "ref", "path")]
    tree = parsed.filter("lang = 'de'").select(urls.content_path(*place).alias("rel_path"))
    cached = parsed.filter("lang = 'fr'").select(
        keys.content_key(*place).alias("key"),
        F.to_json(F.struct(F.base64(F.encode("text", "UTF-8")).alias("content"))).alias("body"),
        F.lit(None).cast("string").alias("error"),
        F.lit("2024-01-20").cast("timestamp").alias("cached_at"),
    )
    plan = jobs.plan_content(store, tree, cached, ASOF)
    blobs = view(spark, sf, "blobs")
    answers = _landed(plan, scenario.content_bodies(plan.open_items, blobs))
    if killed:
        rows = jobs.batched_content(plan, answers).withColumn("status", jobs.outcome_status(F.col("outcome")))
        write_content_table(rows, f"{store.root}/content", "first")
        store.begin("content-first").append("content_status", rows.select("url", "status"))
    jobs.record_content(
        store, plan, answers, scenario.single_answers(blobs), f"{store.root}/content", "first", ASOF
    )
    return store.read("content_status").select("url", "status")


JOB_METADATA = f"""{with_views('repo_bodies')}, {REPOS}, {METADATA}
    SELECT repo_key, stars, forks, coalesce(watchers, -1) AS watchers, language, topics, default_branch FROM repo_metadata
    WHERE repo_key IN (SELECT repo_key FROM repo_files)"""


@query("job_metadata", JOB_METADATA)
def _(spark, sf):
    return _metadata_run(spark, sf)


@query("job_metadata_repeated", JOB_METADATA)
def _(spark, sf):
    """One plan recorded three times: with half of its answers, with all, and with all once more."""
    return _metadata_run(spark, sf, times=3)


def _metadata_run(spark, sf, times=1):
    store = _store(spark, sf)
    nothing = spark.createDataFrame([], "key string, body string, error string, cached_at timestamp")
    plan = jobs.plan_metadata(store, nothing, ASOF)
    landed = checkpointed(_landed(plan, scenario.metadata_bodies(plan.open_items, view(spark, sf, "repo_bodies"))))
    for i in range(times):
        jobs.record_metadata(store, plan, landed if i or times == 1 else landed.filter(F.crc32("request_key") % 2 == 0), ASOF)
    return _stored_metadata(store)


def _stored_metadata(store):
    return store.read("repo_metadata").select(
        "repo_key",
        "stars",
        "forks",
        F.coalesce("watchers", F.lit(-1).cast("bigint")).alias("watchers"),
        "language",
        F.array_join("topics", ",").alias("topics"),
        "default_branch",
    )


@query("late_answers", JOB_METADATA)
def _(spark, sf):
    """Two planners at a time, a third when their leases have ended; answers to the first and the third land, most of them twice."""
    store, bodies = _store(spark, sf), view(spark, sf, "repo_bodies")
    nothing = spark.createDataFrame([], "key string, body string, error string, cached_at timestamp")
    first = jobs.plan_metadata(store, nothing, ASOF, batch_size=20, planner="first")
    second = jobs.plan_metadata(store, nothing, ASOF, planner="second")  # finds every item taken
    third = jobs.plan_metadata(store, nothing, "2024-02-09 00:00:00", batch_size=7, planner="third")
    landed = [_landed(plan, scenario.metadata_bodies(plan.open_items, bodies)) for plan in (first, second, third)]
    early = landed[0].filter(F.crc32("request_key") % 2 == 0)
    answers = checkpointed(early.unionByName(landed[1]).unionByName(landed[2]))
    for delivery in (answers.filter(F.crc32("request_key") % 3 == 0), answers):
        late = jobs.late_plan(store, jobs.METADATA, delivery)
        if late is not None:
            jobs.record_metadata(store, late, delivery, ASOF)
    return _stored_metadata(store).filter(F.lit(second.open_items.isEmpty()))


@query("job_history", f"""{with_views('commit_nodes')}, {PARSED}, {_batched(5)},
    newest AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ord DESC) AS age FROM commit_nodes)
    SELECT b.url, min(strftime(committed_at, '%Y-%m-%dT%H:%M:%SZ')) AS first_commit,
           max(strftime(committed_at, '%Y-%m-%dT%H:%M:%SZ')) AS last_commit,
           count(DISTINCT author) AS n_authors, count(*) AS n_commits
    FROM batched b JOIN newest n ON b.url = n.url AND n.age <= 100
    WHERE NOT ({FAILED_BATCH}) AND NOT ({MISSING_REPO}) AND NOT ({MISSING_REF}) GROUP BY b.url""")
def _(spark, sf):
    store = _store(spark, sf)
    nothing = spark.createDataFrame([], "key string, body string, error string, cached_at timestamp")
    plan = jobs.plan_history(store, nothing, ASOF)
    answers = _landed(plan, scenario.history_bodies(plan.open_items, view(spark, sf, "commit_nodes")))
    jobs.record_history(store, plan, answers, ASOF)
    return audit.history_summary(audit.exploded_commits(store.read("file_history")))


@query("job_content_rerun", f"""{with_views('blobs')}, {PARSED}
    SELECT p.url, md5(b.text) AS text_md5 FROM parsed p JOIN blobs b ON p.url = b.url
    WHERE NOT ({MISSING_REPO}) AND b.blob_found IS NOT NULL AND b.text IS NOT NULL AND (b.text <> '' OR b.is_truncated)
    AND NOT (b.is_truncated AND b.byte_size > 20000)""")
def _(spark, sf):
    """Two runs: the first gets half its answers, the second finds them, and stale ones, in the folder too."""
    store = _store(spark, sf)
    blobs = view(spark, sf, "blobs")
    nowhere = spark.createDataFrame([], "rel_path string")
    landed = None
    for number in range(2):
        plan = jobs.plan_content(store, nowhere, None, ASOF)
        # Batch numbers that no failure rule names.
        spaced = plan.open_items.withColumn("batch_id", F.col("batch_id") * 11)
        bodies = scenario.content_bodies(spaced, blobs).withColumn("batch_id", F.expr("batch_id div 11"))
        fresh = bodies if number else bodies.filter("batch_id % 2 = 0")
        fresh = _landed(plan, fresh).withColumn("answered_at", F.lit("2024-01-30"))
        stale = fresh.select("request_key", F.lit('{"data":{}}').alias("body"), F.lit("2024-01-29").alias("answered_at"))
        new = fresh.unionByName(stale).unionByName(fresh)
        landed = new if landed is None else landed.unionByName(new)
        jobs.record_content(store, plan, landed, scenario.single_answers(blobs), f"{store.root}/content", f"run-{number}", ASOF)
    stored = spark.read.parquet(f"{store.root}/content").filter("status = 'fetched'")
    return stored.select("url", F.md5("text").alias("text_md5"))


@query("job_metadata_second_run", f"""{with_views('repo_bodies')}, {REPOS}, {METADATA},
    gone AS (SELECT DISTINCT repo_key FROM repo_files WHERE repo_key NOT IN (SELECT repo_key FROM repo_metadata))
    SELECT m.mode, g.repo_key FROM gone g, (VALUES ('cached'), ('retry'), ('later')) m(mode)""")
def _(spark, sf):
    """What a second run finds of the repositories that are gone: an error in the cache, unless asked to retry or 30 days on."""
    store = _store(spark, sf)
    plan = jobs.plan_metadata(store, None, ASOF)
    bodies = scenario.metadata_bodies(plan.open_items, view(spark, sf, "repo_bodies"))
    jobs.record_metadata(store, plan, _landed(plan, bodies), ASOF)
    second = jobs.plan_metadata(store, None, ASOF)
    retry = jobs.plan_metadata(store, None, ASOF, retry_errors=True)
    later = jobs.plan_metadata(store, None, "2024-03-15 00:00:00")
    seen = {"cached": second.hits, "asked": second.open_items, "retry": retry.open_items, "later": later.open_items}
    parts = [rows.select(F.lit(mode).alias("mode"), "repo_key") for mode, rows in seen.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query("job_history_second_run", f"""{with_views('commit_nodes')}, {PARSED}, {_batched(5)},
    left_over AS (SELECT url, {FAILED_BATCH} AS failed FROM batched WHERE ({FAILED_BATCH}) OR ({MISSING_REPO}) OR ({MISSING_REF})
                  OR url NOT IN (SELECT url FROM commit_nodes))
    SELECT CASE WHEN failed THEN 'asked' ELSE 'cached' END AS mode, url FROM left_over
    UNION ALL SELECT 'retry', url FROM left_over""")
def _(spark, sf):
    """A second run asks for failed batches only; errors come from the cache, unless they are to be retried."""
    store = _store(spark, sf)
    plan = jobs.plan_history(store, None, ASOF)
    answers = _landed(plan, scenario.history_bodies(plan.open_items, view(spark, sf, "commit_nodes")))
    jobs.record_history(store, plan, answers, ASOF)
    second = jobs.plan_history(store, None, ASOF)
    retry = jobs.plan_history(store, None, ASOF, retry_errors=True)
    seen = {"cached": second.hits, "asked": second.open_items, "retry": retry.open_items}
    parts = [rows.select(F.lit(mode).alias("mode"), "url") for mode, rows in seen.items()]
    return parts[0].union(parts[1]).union(parts[2])


@query("job_content_single", f"""{with_views('blobs')}, {PARSED},
    named AS (SELECT p.url, b.text, p.lang <> 'es' AND b.blob_found IS NOT NULL AND b.text IS NOT NULL AS found
              FROM parsed p JOIN blobs b ON p.url = b.url)
    SELECT url, CASE WHEN found THEN 'fetched' ELSE 'not_found' END AS status,
           CASE WHEN found THEN md5(text) ELSE '' END AS text_md5 FROM named""")
def _(spark, sf):
    """One answer per file: German files are links to the place beside them, Spanish ones link out of the repository."""
    store = _store(spark, sf)
    plan = jobs.plan_content(store, spark.createDataFrame([], "rel_path string"), None, ASOF)
    parsed = state.parsed_files(view(spark, sf, "files")).select("url", "owner", "repo", "ref", "path", "lang")
    blobs = view(spark, sf, "blobs").select("url", "blob_found", "text")
    gone = F.col("blob_found").isNull()
    answer = [
        F.when(gone, 404).otherwise(200).alias("status"),
        F.lit(None).cast("string").alias("error"),
        F.when(~gone, text.encoded_text(F.col("text"))).alias("content"),
        F.lit(False).alias("is_folder"),
    ]
    beside = F.col("lang") == "de"
    place = F.when(beside, F.concat("path", F.lit(".real"))).otherwise(F.col("path")).alias("path")
    files = parsed.filter("lang <> 'es'").join(blobs, "url").select(
        "owner", "repo", "ref", place, *answer, F.lit(False).alias("is_link"), F.lit(None).cast("string").alias("target")
    )
    target = F.when(beside, F.concat(F.substring_index("path", "/", -1), F.lit(".real"))).otherwise("/abs")
    links = parsed.filter("lang IN ('de', 'es')").select(
        "owner", "repo", "ref", "path", F.lit(200).alias("status"), F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("string").alias("content"), F.lit(False).alias("is_folder"), F.lit(True).alias("is_link"),
        target.alias("target"),
    )
    singles.record_content(store, plan, files.unionByName(links), f"{store.root}/content", "first", ASOF)
    texts = spark.read.parquet(f"{store.root}/content").filter("status = 'fetched'").select("url", F.md5("text").alias("_md5"))
    return store.read("content_status").join(texts, "url", "left").select(
        "url", "status", F.coalesce("_md5", F.lit("")).alias("text_md5")
    )


@query("job_metadata_single", f"""{with_views('repo_bodies')}, {REPOS}
    SELECT repo_key, b.seq AS stars, b.seq % 7 AS forks, b.seq % 9 AS watchers, 'ai,t' || (b.seq % 3) AS topics,
           '2024-01-01T00:00:00+00:00' AS created_at, 'MIT' AS license
    FROM repo_bodies b WHERE b.seq % 6 <> 0 AND repo_key IN (SELECT repo_key FROM repo_files)""")
def _(spark, sf):
    store = _store(spark, sf)
    plan = jobs.plan_metadata(store, None, ASOF)
    n = F.col("seq")
    body = F.to_json(F.struct(
        n.alias("stargazers_count"), (n % 7).alias("forks_count"), (n % 9).alias("watchers_count"),
        F.array(F.lit("ai"), F.concat(F.lit("t"), (n % 3).cast("string"))).alias("topics"),
        F.lit("2024-01-01T00:00:00Z").alias("created_at"), F.struct(F.lit("MIT").alias("spdx_id")).alias("license"),
    ))
    answers = view(spark, sf, "repo_bodies").select("repo_key", F.when(n % 6 == 0, 404).otherwise(200).alias("status"), body.alias("body"))
    singles.record_metadata(store, plan, answers, ASOF)
    return store.read("repo_metadata").select(
        "repo_key", "stars", "forks", "watchers", F.array_join("topics", ",").alias("topics"), "created_at", "license"
    )


@query("job_history_single", f"""{with_views('commit_nodes')}, {PARSED}
    SELECT n.url, left(oid, 7) AS sha, coalesce(author, '') AS author,
           CASE WHEN author IS NULL THEN '' ELSE strftime(committed_at, '%Y-%m-%dT%H:%M:%S+00:00') END AS date,
           left(split_part(message, chr(10), 1), 80) AS message
    FROM commit_nodes n JOIN parsed p ON n.url = p.url""")
def _(spark, sf):
    store = _store(spark, sf)
    plan = jobs.plan_history(store, None, ASOF)
    author = F.when(F.col("author").isNotNull(), F.struct(
        F.col("author").alias("name"), F.date_format("committed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date")
    ))
    commit = F.struct(F.col("oid").alias("sha"), F.struct(author.alias("author"), "message").alias("commit"))
    listed = view(spark, sf, "commit_nodes").groupBy("url").agg(F.to_json(F.collect_list(commit)).alias("body"))
    singles.record_history(store, plan, listed.select("url", F.lit(200).alias("status"), "body"), ASOF)
    return audit.exploded_commits(store.read("file_history")).select(
        "url", "sha", F.coalesce("author", F.lit("")).alias("author"), F.coalesce("date", F.lit("")).alias("date"), "message"
    )


@query("job_api", f"""{with_views('request_log')},
    first_run AS (SELECT request_id AS call_id, 1 AS run, false AS is_hit, status,
           CASE WHEN status = 429 OR (status = 403 AND contains(lower(body), 'rate limit')) THEN 'rate_limited'
                WHEN status >= 500 THEN 'retryable' WHEN status < 300 THEN 'success' ELSE 'terminal' END AS disposition,
           CASE WHEN body = '' THEN -1 ELSE CAST(body ->> '$.k' AS BIGINT) END AS k,
           method = 'GET' AND status BETWEEN 200 AND 299 AS kept FROM request_log)
    SELECT call_id, run, is_hit, disposition, status, k FROM first_run
    UNION ALL SELECT call_id, 2, kept, CASE WHEN kept THEN 'success' ELSE 'pending' END, CASE WHEN kept THEN status ELSE -1 END,
           CASE WHEN kept THEN k ELSE -1 END FROM first_run""")
def _(spark, sf):
    """Every call answered once; in the second run nothing is answered, and the cache has what may be kept."""
    store = StateStore(spark, shared_folder(spark))
    store.create()
    log = view(spark, sf, "request_log")
    wanted = log.select(
        F.col("request_id").alias("call_id"), "method", F.concat(F.lit("items/"), F.col("request_id").cast("string")).alias("endpoint"),
        F.create_map(F.lit("kind"), F.lit("event")).alias("params"),
    )
    results = []
    for run in (1, 2):
        plan = calls.plan_calls(store, wanted, ASOF)
        answers = plan.requests.select("call_id", "key", "method").join(
            log.select(F.col("request_id").alias("call_id"), "status", "body", F.col("started_at").alias("answered_at")), "call_id"
        ).select("key", "method", "answered_at", "status", "body", *[F.lit(None).cast("string").alias(c) for c in ("etag", "link")])
        recorded = calls.record_calls(store, plan, answers if run == 1 else answers.limit(0), ASOF)
        results.append(recorded.select(
            "call_id", F.lit(run).alias("run"), "is_hit", "disposition", F.coalesce("status", F.lit(-1)).alias("status"),
            F.coalesce(F.get_json_object("body", "$.k").cast("bigint"), F.lit(-1)).alias("k"),
        ))
    return results[0].unionByName(results[1])


@query("job_compare", f"""{with_views('run_a', 'run_b', 'reported')}, {OVERLAP}
    SELECT o.test, o.n_a, o.n_b, o.a_in_b_pct, o.b_over_api_pct,
           (SELECT count(*) FROM (SELECT test, url FROM run_a EXCEPT SELECT test, url FROM run_b) m
            WHERE m.test = o.test) AS n_missed FROM overlap o""")
def _(spark, sf):
    report = jobs.compare(view(spark, sf, "run_a"), view(spark, sf, "run_b"), view(spark, sf, "reported"))
    missed = report["missed"].groupBy("test").agg(F.count(F.lit(1)).alias("_n"))
    return report["overlap"].join(missed, "test", "left").select(
        "test", "n_a", "n_b", "a_in_b_pct", "b_over_api_pct", F.coalesce("_n", F.lit(0)).alias("n_missed")
    )


@query("resumable_ingest", f"""{with_views('page_attempts')}
    SELECT url, any_value(sha) AS sha, 2 * count(*) AS n_hits FROM page_attempts GROUP BY url""")
def _(spark, sf):
    """Land the pages, take them in, land them again with a restart: a hit for each delivery, a file once."""
    base = shared_folder(spark)
    pages = landed_pages(spark, sf)
    for _ in range(2):
        pages.write.mode("append").json(f"{base}/landed")
        ingest_pages(spark, f"{base}/landed", f"{base}/state", f"{base}/offsets").awaitTermination()
    hits = StateStore(spark, f"{base}/state").read("search_hits").groupBy("url").agg(F.count(F.lit(1)).alias("n_hits"))
    return ingested_files(spark, f"{base}/state").select("url", "sha").join(hits, "url").select("url", "sha", "n_hits")
