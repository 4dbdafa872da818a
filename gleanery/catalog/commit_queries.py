"""State tables over several commits: killed jobs, replaced keys, growth by run, a path scan in rounds."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import audit, paths
from ..operators.ranges import assign_ranges, join_in_range
from ..plans import jobs, views
from ..session import checkpointed, shared_folder
from ..sources.state_store import StateStore
from .registry import query
from .response_queries import ASOF
from .scan_queries import MULTI
from .scenario import table, view, with_views


def _new_store(spark) -> StateStore:
    store = StateStore(spark, shared_folder(spark))
    store.create()
    return store


@query("commit_replay", f"""{with_views('content_status')}
    SELECT f.url, f.sha, 1::BIGINT AS n_hits, coalesce(c.status, 'pending') AS status
    FROM files f LEFT JOIN content_status c ON f.url = c.url""")
def _(spark, sf):
    """A job over three tables is killed behind each of its writes, then repeated until done, and once more."""
    store, files = _new_store(spark), view(spark, sf, "files")
    statuses = view(spark, sf, "content_status")
    writes = [
        lambda c: c.append("files", files.select("url", "sha", "seq")),
        lambda c: c.append("search_hits", files.select("url", "query")),
        lambda c: c.upsert("content_status", statuses, "status"),
    ]
    for made in (1, 2, 3, 4, 4):
        commit = store.begin("replayed")
        if commit.done:
            continue
        for write in writes[:made]:
            write(commit)
        if made > len(writes):
            commit.publish()
    hits = store.read("search_hits").groupBy("url").agg(F.count("*").alias("n_hits"))
    done = store.read("content_status").select("url", "status")
    return store.read("files").join(hits, "url").join(done, "url", "left").select(
        "url", "sha", "n_hits", F.coalesce("status", F.lit("pending")).alias("status")
    )


#: Three deliveries of statuses: some users are in the first only, others are replaced once or twice.
DELIVERIES = """
    WITH updates AS (
        SELECT 1 AS run, event_id AS seq, 'u' || user_id AS url, event_type AS status FROM events WHERE event_type <> 'purchase' AND user_id % 5 <> 0
        UNION ALL SELECT 2, event_id, 'u' || user_id, event_type || '-2' FROM events WHERE user_id % 2 = 0
        UNION ALL SELECT 3, event_id, 'u' || user_id, event_type || '-3' FROM events WHERE user_id % 3 = 0 AND event_type = 'purchase')"""


def _deliveries(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    user, kind = F.col("user_id"), F.col("event_type")
    for run, wanted in ((1, (kind != "purchase") & (user % 5 != 0)), (2, user % 2 == 0), (3, (user % 3 == 0) & (kind == "purchase"))):
        status = kind if run == 1 else F.concat(kind, F.lit(f"-{run}"))
        yield events.filter(wanted).select(
            F.col("event_id").alias("seq"), F.concat(F.lit("u"), user.cast("string")).alias("url"), status.alias("status")
        )


@query("upsert_merge_read", f"""{DELIVERIES}
    SELECT url, arg_max(status, run * 1000000000000 + seq) AS status FROM updates GROUP BY url""")
def _(spark, sf):
    """Untouched, replaced and twice-written keys, read over three folders and the keys that they replace."""
    store = _new_store(spark)
    for rows in _deliveries(spark, sf):
        store.upsert("content_status", rows)
    return store.read("content_status").select("url", "status")


@query("growth_by_run", f"""{DELIVERIES},
    seen AS (SELECT run, url, count(*) AS n FROM updates GROUP BY run, url),
    firsts AS (SELECT url, min(run) AS first_run FROM seen GROUP BY url)
    SELECT s.run::INT AS run, CASE WHEN s.run = first_run THEN 'added' ELSE 'replaced' END AS change, count(*) AS n_rows,
           (SELECT count(*) FROM firsts f WHERE f.first_run <= s.run) AS n_total
    FROM seen s JOIN firsts USING (url) GROUP BY ALL""")
def _(spark, sf):
    """What each of the three runs has added and replaced, and the size of the table as of that run."""
    store, found = _new_store(spark), None
    for run, rows in enumerate(_deliveries(spark, sf), 1):
        before = store.versions()[-1]
        store.upsert("content_status", rows)
        version = store.versions()[-1]
        total = store.read("content_status", version).count()
        change = store.changes("content_status", before, version).groupBy("change").agg(F.count("*").alias("n_rows"))
        grown = change.select(F.lit(run).alias("run"), "change", "n_rows", F.lit(total).cast("bigint").alias("n_total"))
        found = grown if found is None else found.unionByName(grown)
    return found


@query("path_rounds", f"""{with_views('files')}
    SELECT url, min(sha) AS sha, true AS was_hit FROM files WHERE size_bytes BETWEEN 0 AND 1000000 GROUP BY url""")
def _(spark, sf):
    """A whole scan in rounds: in each, a third of the lists lands a round late, and others land twice."""
    store = _new_store(spark)
    files = checkpointed(view(spark, sf, "files").select("query", "url", "sha", "size_bytes"))
    sized = checkpointed(files.groupBy("query", "size_bytes").agg(F.count("*").alias("n")))
    late = None
    while True:
        plan = jobs.plan_paths(store, files, first_chunk=250_000)
        if plan.isEmpty():
            break
        counted = join_in_range(sized, plan, ["query"], "size_bytes", "lo", "hi").groupBy("request").agg(F.sum("n").alias("total_count"))
        probes = checkpointed(plan.select("request", "query", "lo", "hi").join(counted, "request", "left").fillna(0, "total_count"))
        # a size alone is listed however many files have it
        one_list = (F.col("total_count") < paths.RESULT_LIMIT) | (F.col("lo") == F.col("hi"))
        few = probes.filter((F.col("total_count") > 0) & one_list)
        listed = assign_ranges(files, few, ["query"], "size_bytes", "lo", "hi")
        place = F.row_number().over(Window.partitionBy("request").orderBy("size_bytes", "url")) - 1
        items = checkpointed(listed.withColumn("place", place).select(
            F.col("request").alias("query"), (F.floor(F.col("place") / paths.ITEMS_PER_PAGE) + 1).alias("page"), F.lit(1).alias("attempt"),
            "total_count", (F.col("place") % paths.ITEMS_PER_PAGE).alias("item_no"), "url", "sha",
        ))
        held = (F.pmod(F.xxhash64("query", "page"), F.lit(3)) == 0) & (F.col("page") <= paths.PAGES_PER_QUERY)
        now = items.filter(~held) if late is None else items.filter(~held).unionByName(late)
        jobs.record_paths(store, plan, probes, now.unionByName(now), ASOF)
        late = items
    hits = store.read("search_hits").select("url").distinct().withColumn("was_hit", F.lit(True))
    return store.read("files").join(hits, "url", "left").select("url", "sha", "was_hit")


@query("multi_range_hits_incremental", MULTI)
def _(spark, sf):
    """Three deliveries of hits, the second one twice; each refresh reads its own delivery only."""
    store, hits = _new_store(spark), checkpointed(view(spark, sf, "hits"))
    deal = F.pmod(F.xxhash64("url", "size_min"), F.lit(3))
    for i in (0, 1, 1, 2):
        store.append("search_hits", hits.filter(deal == i))
        views.refresh_hit_ranges(store)
    return audit.multi_range_hits(views.refresh_hit_ranges(store))
