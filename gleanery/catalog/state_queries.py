"""State tables: scans, missing work, first-wins and last-wins."""

from pyspark.sql import functions as F

from ..functions import keys, text, urls
from ..operators import audit, state
from ..sources import content_tree
from ..sources.state_store import StateStore
from ..session import checkpointed, shared_folder
from .registry import query
from .scenario import table, view, with_views

PARSED = """parsed AS (
    SELECT seq, url, sha, size_bytes, query, lang, text, seg[1] AS owner, seg[2] AS repo, seg[4] AS ref,
           array_to_string(seg[5:], '/') AS path
    FROM (SELECT *, string_split(substr(url, 20), '/') AS seg FROM files) s
    WHERE starts_with(url, 'https://github.com/') AND len(seg) >= 5 AND seg[3] = 'blob')"""

REPOS = """repo_files AS (
    SELECT seq, url, CASE WHEN len(seg) >= 2 THEN seg[1] ELSE '/' END || '/'
           || CASE WHEN len(seg) >= 3 THEN seg[2] ELSE '' END AS repo_key
    FROM (SELECT *, string_split(substr(url, 20), '/') AS seg FROM files) s
    WHERE lower(left(url, 19)) = 'https://github.com/')"""

METADATA = """repo_metadata AS (
    SELECT repo_key, seq, CAST(j ->> '$.stargazerCount' AS BIGINT) AS stars,
           CAST(j ->> '$.forkCount' AS BIGINT) AS forks,
           CAST(j ->> '$.watchers.totalCount' AS BIGINT) AS watchers,
           j ->> '$.primaryLanguage.name' AS language,
           'ai,' || (j ->> '$.repositoryTopics.nodes[2].topic.name') AS topics,
           j ->> '$.createdAt' AS created_at, j ->> '$.updatedAt' AS updated_at,
           j ->> '$.pushedAt' AS pushed_at, j ->> '$.defaultBranchRef.name' AS default_branch,
           j ->> '$.licenseInfo.spdxId' AS license, j ->> '$.description' AS description
    FROM (SELECT repo_key, seq, json_extract(body, '$.data.r0') AS j FROM repo_bodies) b
    WHERE j IS NOT NULL AND json_type(j) <> 'NULL')"""

FILES = with_views("files")


@query("scan_files", f"{FILES} SELECT url, seq FROM files")
def _(spark, sf):
    return state.scan_files(view(spark, sf, "files"))


@query("create_state", f"{FILES} SELECT url, sha, size_bytes, seq FROM files")
def _(spark, sf):
    """Create the tables, put the scenario's files in, create again: nothing is lost."""
    store = StateStore(spark, shared_folder(spark))
    store.create()
    store.append("files", view(spark, sf, "files"))
    store.create()
    return store.read("files").select("url", "sha", "size_bytes", "seq")


@query("append_hits", f"{with_views('hits')} SELECT url, query, size_min, size_max FROM hits "
       "UNION ALL SELECT url, query, size_min, size_max FROM hits")
def _(spark, sf):
    hits = view(spark, sf, "hits")
    return state.append_rows(hits, hits)


@query("append_union", f"{with_views('incoming')} SELECT seq, url, sha FROM files "
       "UNION ALL SELECT seq, url, sha FROM incoming")
def _(spark, sf):
    files = view(spark, sf, "files").select("seq", "url", "sha")
    return state.append_rows(files, view(spark, sf, "incoming"))


@query("file_count", f"{FILES} SELECT count(*) AS n_files FROM files")
def _(spark, sf):
    return state.file_count(view(spark, sf, "files"))


@query("parse_urls", f"{FILES}, {PARSED} SELECT url, owner, repo, ref, path FROM parsed")
def _(spark, sf):
    return state.parsed_files(view(spark, sf, "files").select("url"))


@query("rejected_urls", f"{FILES}, {PARSED} SELECT url FROM files WHERE url NOT IN (SELECT url FROM parsed)")
def _(spark, sf):
    return state.rejected_files(view(spark, sf, "files").select("url"))


@query("repo_keys", f"{FILES}, {REPOS} SELECT url, repo_key FROM repo_files")
def _(spark, sf):
    return state.repo_keys(view(spark, sf, "files").select("url"))


@query("unique_repos", f"{FILES}, {REPOS} SELECT repo_key, min(seq) AS seq FROM repo_files GROUP BY repo_key")
def _(spark, sf):
    return state.unique_repos(view(spark, sf, "files"))


@query("content_paths", f"{FILES}, {PARSED} SELECT url, owner || '/' || repo || '/blob/' || ref || '/' || path "
       "AS rel_path FROM parsed")
def _(spark, sf):
    parsed = state.parsed_files(view(spark, sf, "files").select("url"))
    place = urls.content_path(F.col("owner"), F.col("repo"), F.col("ref"), F.col("path"))
    return parsed.select("url", place.alias("rel_path"))


@query("decode_content", f"{FILES} SELECT seq, text FROM files")
def _(spark, sf):
    files = view(spark, sf, "files")
    landed = files.select("seq", text.encoded_text(F.col("text")).alias("content"))
    return landed.select("seq", text.decoded_text(F.col("content")).alias("text"))


@query("encode_content", f"{FILES} SELECT seq, base64(encode(text)) AS content, "
       "CAST(octet_length(encode(text)) AS BIGINT) AS size FROM files")
def _(spark, sf):
    return view(spark, sf, "files").select(
        "seq",
        text.encoded_text(F.col("text")).alias("content"),
        F.octet_length("text").cast("bigint").alias("size"),
    )


@query("truncate_content", f"{FILES} SELECT seq, CASE WHEN length(text) > 10000 THEN left(text, 10000) "
       "|| chr(10) || chr(10) || '[truncated]' ELSE text END AS text FROM files")
def _(spark, sf):
    return view(spark, sf, "files").select("seq", text.clipped_text(F.col("text")).alias("text"))


@query("report_rows", f"""{FILES},
    shown AS (SELECT seq, CASE WHEN starts_with(url, 'https://github.com/') THEN substr(url, 20) ELSE url END AS u,
                     text, left(text, 117) AS head FROM files)
    SELECT seq, CASE WHEN length(u) > 25 THEN left(u, 11) || '...' || right(u, 11) ELSE u END AS short_url,
           replace(replace(replace(replace(replace(
               CASE WHEN length(text) <= 120 THEN text
                    WHEN strpos(head, ' ') > 0 THEN left(head, length(head) - strpos(reverse(head), ' ')) || '...'
                    ELSE head || '...' END,
               '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '|', '&#124;') AS cell
    FROM shown""")
def _(spark, sf):
    return view(spark, sf, "files").select(
        "seq",
        text.short_url(F.col("url"), width=25).alias("short_url"),
        text.cell_escaped(text.short_text(F.col("text"))).alias("cell"),
    )


@query("cache_keys", f"""{FILES}, {PARSED}
    SELECT url,
           left(sha256('contents|{{"owner": "' || owner || '", "path": "' || path || '", "ref": "' || ref
                       || '", "repo": "' || repo || '"}}'), 16) AS content_key,
           left(sha256('file_history|{{"owner": "' || owner || '", "path": "' || path || '", "repo": "'
                       || repo || '"}}'), 16) AS history_key,
           left(sha256('repo_metadata|{{"repo_key": "' || owner || '/' || repo || '"}}'), 16) AS metadata_key,
           left(sha256('search/code|{{"page": 1, "per_page": 100, "q": "' || query || '"}}'), 16) AS search_key,
           left(sha256('graphql|{{"query": "{{ repository(name: \\"' || repo || '\\") }}", "variables": {{}}}}'), 16)
               AS batch_key
    FROM parsed""")
def _(spark, sf):
    parsed = state.parsed_files(view(spark, sf, "files"))
    owner, repo, ref, path = (F.col(c) for c in ("owner", "repo", "ref", "path"))
    return parsed.select(
        "url",
        keys.content_key(owner, repo, ref, path).alias("content_key"),
        keys.history_key(owner, repo, path).alias("history_key"),
        keys.metadata_key(F.concat_ws("/", owner, repo)).alias("metadata_key"),
        keys.search_key(F.col("query"), F.lit(100), F.lit(1)).alias("search_key"),
        keys.batch_key(F.concat(F.lit('{ repository(name: "'), repo, F.lit('") }'))).alias("batch_key"),
    )


@query("render_queries", f"{with_views('hits')} SELECT url, query || ' size:' || size_min || '..' || size_max "
       "AS ranged, replace('in+' || query || '+size:' || size_min, '+', ' ') AS sent FROM hits")
def _(spark, sf):
    hits = view(spark, sf, "hits")
    typed = F.concat(F.lit("in+"), F.col("query"), F.lit("+size:"), F.col("size_min").cast("string"))
    return hits.select(
        "url",
        urls.ranged_query(F.col("query"), F.col("size_min"), F.col("size_max")).alias("ranged"),
        urls.sent_query(typed).alias("sent"),
    )


@query("request_params", r"""
    WITH parts AS (SELECT page_id, regexp_replace(split_part(url, '?', 1), '^[a-z]+://', '') AS endpoint,
                          string_split(url, '?') AS halves FROM pages),
    args AS (SELECT page_id, a.arg, a.no FROM parts,
             LATERAL (SELECT unnest(string_split(halves[2], '&')) AS arg,
                             generate_subscripts(string_split(halves[2], '&'), 1) AS no) a
             WHERE len(halves) > 1),
    pairs AS (SELECT page_id, split_part(arg, '=', 1) AS k, no,
                     CASE WHEN strpos(arg, '=') > 0 THEN substr(arg, strpos(arg, '=') + 1) ELSE '' END AS v FROM args),
    last_pairs AS (SELECT page_id, k, arg_max(v, no) AS v FROM pairs GROUP BY page_id, k),
    joined AS (SELECT page_id, string_agg(k || '=' || v, '&' ORDER BY k) AS params,
                      string_agg('"' || k || '": "' || v || '"', ', ' ORDER BY k) AS json
               FROM last_pairs GROUP BY page_id)
    SELECT left(sha256(p.endpoint || '|{' || coalesce(j.json, '') || '}'), 16) AS call_key, p.page_id, CASE WHEN starts_with(p.endpoint, '/') THEN p.endpoint ELSE '/' || p.endpoint END AS endpoint,
           coalesce(j.params, '') AS params
    FROM parts p LEFT JOIN joined j ON p.page_id = j.page_id""")
def _(spark, sf):
    """Page URLs taken as typed calls: what is before "?" is the endpoint, the rest are arguments."""
    halves = F.split("url", r"\?")
    args = F.when(F.size(halves) > 1, F.split(F.get(halves, 1), "&")).otherwise(F.array().cast("array<string>"))
    calls = table(spark, sf, "pages").select(
        "page_id",
        F.regexp_replace(F.get(halves, 0), "^[a-z]+://", "").alias("typed"),
        urls.params_map(args).alias("params"),
    )
    entry = F.transform(F.array_sort(F.map_entries("params")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return calls.select(
        "page_id",
        urls.rooted_endpoint(F.col("typed")).alias("endpoint"),
        F.array_join(entry, "&").alias("params"),
        keys.call_key(F.col("typed"), F.col("params")).alias("call_key"),
    )


@query("files_without_content", f"{with_views('content_status')} SELECT url, seq FROM files f "
       "WHERE NOT EXISTS (SELECT 1 FROM content_status c WHERE c.url = f.url)")
def _(spark, sf):
    files = view(spark, sf, "files").select("url", "seq")
    return state.files_without_content(files, view(spark, sf, "content_status"))


@query("files_without_history", f"{with_views('commit_nodes')} SELECT url, seq FROM files f "
       "WHERE NOT EXISTS (SELECT 1 FROM commit_nodes c WHERE c.url = f.url)")
def _(spark, sf):
    files = view(spark, sf, "files").select("url", "seq")
    return state.files_without_history(files, view(spark, sf, "commit_nodes"))


@query("repos_without_metadata", f"{with_views('repo_bodies')}, {REPOS}, {METADATA} "
       "SELECT repo_key, min(seq) AS seq FROM repo_files "
       "WHERE repo_key NOT IN (SELECT repo_key FROM repo_metadata) GROUP BY repo_key")
def _(spark, sf):
    from .response_queries import stored_metadata

    stored = checkpointed(stored_metadata(spark, sf))
    return state.repos_without_metadata(view(spark, sf, "files"), stored)


@query("split_on_disk", f"{FILES}, {PARSED} SELECT url, owner || '/' || repo || '/blob/' || ref || '/' || path "
       "AS rel_path, lang = 'en' AS on_disk FROM parsed")
def _(spark, sf):
    parsed = state.parsed_files(view(spark, sf, "files"))
    place = urls.content_path(F.col("owner"), F.col("repo"), F.col("ref"), F.col("path"))
    tree = parsed.filter("lang = 'en'").select(place.alias("rel_path"))
    return content_tree.split_on_disk(parsed, tree).select("url", "rel_path", "on_disk")


@query("insert_files", f"""{with_views('incoming')} SELECT seq, url, sha FROM files
    UNION ALL SELECT seq, url, sha FROM
      (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS rn FROM incoming) i
      WHERE rn = 1 AND url NOT IN (SELECT url FROM files)""")
def _(spark, sf):
    files = view(spark, sf, "files").select("seq", "url", "sha")
    return state.insert_files(files, view(spark, sf, "incoming"))


@query("upsert_status", f"""{with_views('content_status', 'status_updates')},
    latest AS (SELECT url, arg_max(status, seq) AS status FROM status_updates GROUP BY url)
    SELECT url, status FROM latest
    UNION ALL SELECT url, status FROM content_status WHERE url NOT IN (SELECT url FROM latest)""")
def _(spark, sf):
    return state.upsert(view(spark, sf, "content_status"), view(spark, sf, "status_updates"), "url")


@query("upsert_metadata", f"""{with_views('repo_bodies')}, {METADATA},
    updates AS (SELECT split_part(repo_key, '/', 1) || '/' ||
                       CASE WHEN language IS NULL THEN split_part(repo_key, '/', 2) ELSE 'moved' END AS repo_key,
                       seq, stars, description FROM repo_metadata),
    latest AS (SELECT repo_key, arg_max(stars, seq) AS stars, arg_max(description, seq) AS description
               FROM updates GROUP BY repo_key)
    SELECT repo_key, stars, -1 AS forks, '' AS topics, description FROM latest
    UNION ALL SELECT repo_key, stars, forks, topics, description FROM repo_metadata
    WHERE repo_key NOT IN (SELECT repo_key FROM latest)""")
def _(spark, sf):
    """Updates without forks and topics; many repositories of an owner move to one key."""
    from .response_queries import stored_metadata

    current = stored_metadata(spark, sf)
    owner = F.substring_index("repo_key", "/", 1)
    name = F.when(F.col("language").isNull(), F.substring_index("repo_key", "/", -1)).otherwise("moved")
    updates = current.select(F.concat_ws("/", owner, name).alias("repo_key"), "seq", "stars", "description")
    stored = current.drop("seq")
    return state.upsert_metadata(stored, updates).select(
        "repo_key",
        "stars",
        F.coalesce("forks", F.lit(-1)).alias("forks"),
        F.array_join("topics", ",").alias("topics"),
        "description",
    )


@query("upsert_history", f"""{with_views('commit_nodes')},
    stored AS (SELECT url, string_agg(left(oid, 7), ',' ORDER BY ord) AS commits FROM commit_nodes GROUP BY url),
    updates AS (
        SELECT url, ord, CASE WHEN author IS NULL THEN '' ELSE left(oid, 7) END AS commits
        FROM commit_nodes WHERE message LIKE 'purchase %' AND url LIKE '%/en/%'
        UNION ALL SELECT url || '.new', ord, left(oid, 7) FROM commit_nodes WHERE message LIKE 'error %'),
    latest AS (SELECT url, arg_max(commits, ord) AS commits FROM updates GROUP BY url)
    SELECT url, commits FROM latest
    UNION ALL SELECT url, commits FROM stored WHERE url NOT IN (SELECT url FROM latest)""")
def _(spark, sf):
    """Whole stored histories: those of one language are replaced by single commits, new files come in."""
    nodes = view(spark, sf, "commit_nodes")
    commit = F.struct(F.left("oid", F.lit(7)).alias("sha"))
    ordered = F.array_sort(F.collect_list(F.struct("ord", commit.alias("commit"))))
    stored = nodes.groupBy("url").agg(F.transform(ordered, lambda c: c["commit"]).alias("commits"))
    alone = F.when(F.col("author").isNotNull(), F.array(commit)).otherwise(F.array().cast("array<struct<sha:string>>"))
    wanted = F.col("message").startswith("purchase ") & F.contains("url", F.lit("/en/"))
    replacing = nodes.filter(wanted).select("url", F.col("ord").alias("seq"), alone.alias("commits"))
    adding = nodes.filter(F.col("message").startswith("error ")).select(
        F.concat("url", F.lit(".new")).alias("url"), F.col("ord").alias("seq"), F.array(commit).alias("commits")
    )
    return state.upsert(stored, replacing.unionByName(adding), "url").select("url", F.array_join("commits.sha", ",").alias("commits"))


#: The first run sees all but purchases, the second one a third of the queries and some that are new.
PROGRESS = """
    WITH updates AS (
        SELECT 1 AS run, event_id AS seq, 'q' || user_id AS query, event_id % 1000 AS last_lo, event_id AS collected,
               event_type = 'view' AS completed FROM events WHERE event_type <> 'purchase'
        UNION ALL
        SELECT 2, event_id, 'q' || user_id || CASE WHEN event_type = 'click' THEN '.new' ELSE '' END, event_id % 1000,
               event_id, event_type = 'purchase' FROM events WHERE user_id % 3 = 0),
    latest AS (SELECT query, max(run) AS run FROM updates GROUP BY query)"""


@query("upsert_progress", f"""{PROGRESS}
    SELECT query, arg_max(last_lo, seq) AS last_lo, CAST(1000000 AS BIGINT) AS max_size, arg_max(collected, seq) AS collected,
           CASE WHEN arg_max(completed, seq) THEN '2024-0' || run || '-01' ELSE 'open' END AS completed_on, '2024-0' || run || '-01' AS updated_on
    FROM updates JOIN latest USING (query, run) GROUP BY query, run""")
def _(spark, sf):
    """Two runs: untouched queries keep their times, replaced ones may be open again, new ones appear."""
    events = table(spark, sf, "events")
    kind, user = F.col("event_type"), F.col("user_id").cast("string")

    def run(rows, query, completed):
        return rows.select(
            F.col("event_id").alias("seq"), query.alias("query"), (F.col("event_id") % 1000).alias("last_lo"),
            F.lit(1_000_000).cast("bigint").alias("max_size"), F.col("event_id").alias("collected"), completed.alias("completed"),
        )

    first = run(events.filter(kind != "purchase"), F.concat(F.lit("q"), user), kind == "view")
    renamed = F.concat(F.lit("q"), user, F.when(kind == "click", ".new").otherwise(""))
    second = run(events.filter(F.col("user_id") % 3 == 0), renamed, kind == "purchase")
    done = state.upsert_progress(state.empty_state(spark)["scan_progress"], first, "2024-01-01 00:00:00")
    done = state.upsert_progress(done, second, "2024-02-01 00:00:00")
    return done.select(
        "query", "last_lo", "max_size", "collected",
        F.coalesce(F.date_format("completed_at", "yyyy-MM-dd"), F.lit("open")).alias("completed_on"),
        F.date_format("updated_at", "yyyy-MM-dd").alias("updated_on"),
    )


@query("sample_urls", f"{FILES} SELECT url, seq FROM files ORDER BY seq LIMIT 10")
def _(spark, sf):
    return audit.sample_urls(view(spark, sf, "files"))


@query("content_tree_scan", f"{FILES}, {PARSED} SELECT owner || '/' || repo || '/blob/' || ref || '/' || path "
       "AS rel_path FROM parsed")
def _(spark, sf):
    """Write every file into a new tree, then list the tree."""
    base = shared_folder(spark).removeprefix("file:")
    written = content_tree.export_tree(state.parsed_files(view(spark, sf, "files")), base)
    written.write.format("noop").mode("overwrite").save()
    return content_tree.list_tree(spark, base)


@query("content_sink", f"{FILES}, {PARSED} SELECT url, owner, repo, ref, path, text FROM parsed")
def _(spark, sf):
    """Write the content table in two runs, half of the texts each, and read both."""
    path = shared_folder(spark)
    content = state.parsed_files(view(spark, sf, "files")).withColumn("status", F.lit("fetched"))
    first = content.filter(F.crc32("url") % 2 == 0)
    runs = [first, content.join(first.select("url"), "url", "left_anti").select(*content.columns)]
    parts = [content_tree.write_content_table(rows, path, name) for rows, name in zip(runs, ("first", "second"))]
    written = parts[0].unionByName(parts[1])
    return written.select("url", "owner", "repo", "ref", "path", "text")


@query("export_json", f"""{with_views('repo_bodies')}, {METADATA}
    SELECT '{{"repo_key":"' || repo_key || '","stars":' || stars || ',"language":'
           || CASE WHEN language IS NULL THEN 'null' ELSE '"' || language || '"' END
           || ',"topics":["' || replace(topics, ',', '","') || '"],"license":null}}' AS value
    FROM repo_metadata""")
def _(spark, sf):
    from .response_queries import stored_metadata

    columns = stored_metadata(spark, sf).select("repo_key", "stars", "language", "topics", "license")
    path = shared_folder(spark)
    content_tree.export_json(columns, path)
    return spark.read.text(path)


@query("pending_by_repo", f"""{with_views('content_status')}, {PARSED}
    SELECT owner, repo, count(*) AS n_pending, CAST(sum(size_bytes) AS BIGINT) AS bytes
    FROM parsed p WHERE NOT EXISTS (SELECT 1 FROM content_status c WHERE c.url = p.url)
    GROUP BY owner, repo""")
def pending_by_repo(spark, sf):
    """Flagship: files still without content, per repository."""
    pending = state.files_without_content(view(spark, sf, "files"), view(spark, sf, "content_status"))
    return (
        state.parsed_files(pending)
        .groupBy("owner", "repo")
        .agg(F.count(F.lit(1)).alias("n_pending"), F.sum("size_bytes").alias("bytes"))
        .orderBy(F.col("n_pending").desc(), "owner", "repo")
    )
