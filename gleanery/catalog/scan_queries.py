"""Size ranges: histogram, scan, fetched items, hits and comparisons of collections."""

from pyspark.sql import functions as F

from ..operators import audit, ranges, scan
from ..operators.links import resolve_links
from ..plans import jobs
from ..session import checkpointed
from .registry import query
from .scenario import view, with_views

# Small limits, so that every branch of the scan occurs on the test tables.
LIMITS = scan.ScanLimits(cap=3, first_chunk=500, max_size=1_000_000, empty_stop=10)


def _walk(
    estimates: str,
    starts: str = "SELECT DISTINCT query, CAST(0 AS BIGINT) AS start_lo FROM files",
    size: str = "size_bytes",
) -> str:
    """The scan as a recursive query; one row per range asked for."""
    return f"""starts AS ({starts}),
    actual AS (SELECT query, {size} AS size, count(*) AS n FROM files GROUP BY query, {size}),
    claimed AS ({estimates}),
    walk AS (
        SELECT query, CAST(-1 AS BIGINT) AS step, CAST(NULL AS BIGINT) AS lo, CAST(NULL AS BIGINT) AS hi,
               CAST(NULL AS BIGINT) AS est, CAST(NULL AS BIGINT) AS got, 'begin' AS action,
               start_lo AS next_lo, CAST(500 AS BIGINT) AS chunk, CAST(0 AS BIGINT) AS empties
        FROM starts
        UNION ALL
        SELECT query, step, lo, hi, est, CASE WHEN action IN ('collect', 'overflow') THEN got END, action,
               CASE WHEN action IN ('empty', 'collect') THEN hi + 1 ELSE lo END,
               CASE WHEN action IN ('empty', 'collect') THEN least(chunk * 2, 1000000)
                    WHEN action IN ('narrow', 'overflow') THEN greatest(chunk // 2, 1) ELSE chunk END,
               CASE WHEN est = 0 THEN empties + 1 ELSE 0 END
        FROM (SELECT *, CASE WHEN est = 0 THEN CASE WHEN empties + 1 >= 10 THEN 'stop' ELSE 'empty' END
                             WHEN est >= 3 AND lo < hi THEN 'narrow'
                             WHEN got >= 3 AND lo < hi THEN 'overflow' ELSE 'collect' END AS action
              FROM (SELECT w.query, w.step + 1 AS step, w.next_lo AS lo,
                           least(w.next_lo + w.chunk - 1, 1000000) AS hi, w.chunk, w.empties,
                           CAST(coalesce((SELECT sum(e.est) FROM claimed e WHERE e.query = w.query AND e.size
                               BETWEEN w.next_lo AND least(w.next_lo + w.chunk - 1, 1000000)), 0) AS BIGINT) AS est,
                           CAST(least(coalesce((SELECT sum(a.n) FROM actual a WHERE a.query = w.query AND a.size
                               BETWEEN w.next_lo AND least(w.next_lo + w.chunk - 1, 1000000)), 0), 3) AS BIGINT) AS got
                    FROM walk w WHERE w.next_lo <= 1000000 AND w.action <> 'stop') s) t),
    plan AS (SELECT query, step, lo, hi, est, got, action FROM walk WHERE step >= 0)"""


TRUE_COUNTS = "SELECT query, size, n AS est FROM actual"
CLAIMED = "SELECT query, size, est FROM estimates"

def _fetched(size: str = "size_bytes") -> str:
    return f"""fetched AS (
    SELECT * FROM (
        SELECT p.query, p.step, p.lo, p.hi, p.action, f.seq, f.url, f.sha,
               row_number() OVER (PARTITION BY p.query, p.step ORDER BY f.seq) AS rn
        FROM plan p JOIN files f ON f.query = p.query AND {size} BETWEEN p.lo AND p.hi
        WHERE p.action IN ('collect', 'overflow')) r
    WHERE rn <= 3)"""


def _items(spark, sf):
    return view(spark, sf, "files").select("seq", "query", "url", "sha", "size_bytes")


def _claimed_plan(spark, sf):
    return scan.scan_plan(_items(spark, sf), view(spark, sf, "estimates"), limits=LIMITS)


# Ranges not fetched show -1 results.
PLAN_ROWS = "SELECT query, step, lo, hi, est, coalesce(got, -1) AS got, action FROM plan"


def _shown(plan):
    return plan.withColumn("got", F.coalesce("got", F.lit(-1).cast("bigint")))


def _fetched_items(plan, items):
    """As in the job: the plan is written out, so the walk runs once."""
    return scan.fetched_items(checkpointed(plan), items, LIMITS)


@query("size_histogram", f"""{with_views('files')},
    counts AS (SELECT query, size_bytes AS size, count(*) AS n FROM files
               WHERE size_bytes BETWEEN 0 AND 1000000 GROUP BY query, size_bytes)
    SELECT query, size, n, CAST(sum(n) OVER (PARTITION BY query ORDER BY size) AS BIGINT) AS running FROM counts""")
def _(spark, sf):
    return scan.size_histogram(_items(spark, sf))


@query("size_histogram_off_axis", f"""{with_views('files')},
    counts AS (SELECT query, CASE WHEN size_bytes BETWEEN 0 AND 1000 THEN size_bytes END AS size, count(*) AS n
               FROM files GROUP BY ALL)
    SELECT query, coalesce(size, -1) AS size, n, CAST(sum(n) OVER (PARTITION BY query ORDER BY size NULLS LAST) AS BIGINT) AS running
    FROM counts""")
def _(spark, sf):
    """On an axis that many files are longer than: those are counted in a row of their own, here of size -1."""
    return scan.size_histogram(_items(spark, sf), scan.ScanLimits(max_size=1_000), off_axis=True).fillna(-1, "size")


@query("reported_totals", f"{with_views('files')} SELECT query, count(*) AS total_count FROM files GROUP BY query")
def _(spark, sf):
    return scan.reported_totals(_items(spark, sf))


@query("scan_plan", f"{with_views('files', recursive=True)}, {_walk(TRUE_COUNTS)} {PLAN_ROWS}")
def _(spark, sf):
    return _shown(scan.scan_plan(_items(spark, sf), limits=LIMITS))


@query("scan_overflow", f"{with_views('estimates', recursive=True)}, {_walk(CLAIMED)} {PLAN_ROWS}")
def _(spark, sf):
    return _shown(_claimed_plan(spark, sf))


# Sizes in hundreds of bytes: then many files share one size, and single sizes are over the cap.
COARSE = "CAST(floor(size_bytes / 100.0) AS BIGINT)"


@query("scan_exact_ceiling", f"""{with_views('files', recursive=True)}, {_walk(TRUE_COUNTS, size=COARSE)},
    {_fetched(COARSE)} SELECT query, lo, seq, url FROM fetched WHERE lo = hi""")
def _(spark, sf):
    items = _items(spark, sf).withColumn("size_bytes", F.expr(COARSE))
    fetched = _fetched_items(scan.scan_plan(items, limits=LIMITS), items)
    return fetched.filter("lo = hi").select("query", "lo", "seq", "url")


@query("scan_hits", f"""{with_views('estimates', recursive=True)}, {_walk(CLAIMED)}, {_fetched()}
    SELECT url, query || ' size:' || lo || '..' || hi AS query, lo AS size_min, hi AS size_max FROM fetched""")
def _(spark, sf):
    return scan.scan_hits(_fetched_items(_claimed_plan(spark, sf), _items(spark, sf)))


@query("scan_collect", f"""{with_views('estimates', recursive=True)}, {_walk(CLAIMED)}, {_fetched()}
    SELECT query, step, seq, url, sha FROM fetched WHERE action = 'collect'""")
def _(spark, sf):
    fetched = _fetched_items(_claimed_plan(spark, sf), _items(spark, sf))
    return scan.scan_collected(fetched).select("query", "step", "seq", "url", "sha")


RESUMED = """SELECT query, CAST(CASE WHEN min(size_bytes) % 2 = 0 THEN 1000 ELSE 0 END AS BIGINT) AS start_lo
    FROM files GROUP BY query HAVING query NOT LIKE '%5'"""


@query("scan_resume", f"{with_views('files', recursive=True)}, {_walk(TRUE_COUNTS, RESUMED)} {PLAN_ROWS}")
def _(spark, sf):
    """Searches ending in 5 are finished; some others go on from size 1000."""
    items = _items(spark, sf)
    begun = items.groupBy("query").agg(F.min("size_bytes").alias("_least"))
    progress = begun.filter((F.col("_least") % 2 == 0) | F.col("query").like("%5")).select(
        "query",
        F.lit(1000).alias("last_lo"),
        F.when(F.col("query").like("%5"), F.lit("2024-01-01").cast("timestamp")).alias("completed_at"),
    )
    return _shown(scan.scan_plan(items, scans=scan.open_scans(items, progress), limits=LIMITS))


@query("assign_ranges", f"""{with_views('files', recursive=True)}, {_walk(TRUE_COUNTS)}
    SELECT f.query, f.url, f.size_bytes, p.step, p.lo, p.hi FROM files f JOIN plan p
    ON f.query = p.query AND f.size_bytes BETWEEN p.lo AND p.hi WHERE p.action = 'collect'""")
def _(spark, sf):
    items = _items(spark, sf)
    accepted = scan.scan_plan(items, limits=LIMITS).filter("action = 'collect'").select("query", "step", "lo", "hi")
    placed = ranges.assign_ranges(items, accepted, ["query"], "size_bytes", "lo", "hi")
    return placed.select("query", "url", "size_bytes", "step", "lo", "hi")


@query("resolve_symlinks", """
    WITH RECURSIVE links AS (SELECT conv_id, turn FROM conversations),
    hops AS (SELECT conv_id, turn, turn AS stop FROM links
             UNION ALL SELECT h.conv_id, h.turn, h.stop - 1 FROM hops h
             WHERE h.stop > 0 AND h.stop % 4 <> 3
               AND EXISTS (SELECT 1 FROM links l WHERE l.conv_id = h.conv_id AND l.turn = h.stop)),
    ends AS (SELECT conv_id, turn, min(stop) AS stop FROM hops GROUP BY conv_id, turn)
    SELECT 'o/r' || e.conv_id AS repo_key, 'd/f' || e.turn AS path,
           CASE WHEN e.stop = 0 AND l.turn IS NOT NULL THEN 'd/f0' END AS final_path,
           CASE WHEN l.turn IS NULL THEN 'not_found' WHEN e.stop = 0 THEN 'resolved' ELSE 'unresolvable_symlink' END AS status
    FROM ends e LEFT JOIN links l ON l.conv_id = e.conv_id AND l.turn = e.stop""")
def _(spark, sf):
    return resolve_links(view(spark, sf, "links"))


# --- audit -------------------------------------------------------------------------------


MULTI = f"""{with_views('hits')}
    SELECT url, count(DISTINCT size_min || '-' || size_max) AS range_count,
           string_agg(DISTINCT size_min || '..' || size_max, ',' ORDER BY size_min || '..' || size_max) AS ranges
    FROM hits GROUP BY url HAVING count(DISTINCT size_min || '-' || size_max) > 1"""


@query("multi_range_hits", MULTI)
def _(spark, sf):
    return audit.multi_range_hits(view(spark, sf, "hits"))


@query("order_multi_range", f"{MULTI} ORDER BY range_count DESC, url")
def _(spark, sf):
    return audit.multi_range_hits(view(spark, sf, "hits"))


def _runs(spark, sf):
    return view(spark, sf, "run_a"), view(spark, sf, "run_b"), view(spark, sf, "reported")


def _overlap(run_a: str = "run_a", run_b: str = "run_b", reported: str = "reported") -> str:
    return f"""counts AS (
        SELECT test, count(in_a) AS n_a, count(in_b) AS n_b, count(CASE WHEN in_a = 1 AND in_b = 1 THEN 1 END) AS n_both
        FROM (SELECT coalesce(a.test, b.test) AS test, a.in_a, b.in_b
              FROM (SELECT DISTINCT test, url, 1 AS in_a FROM {run_a}) a
              FULL JOIN (SELECT DISTINCT test, url, 1 AS in_b FROM {run_b}) b ON a.test = b.test AND a.url = b.url) j
        GROUP BY test),
    overlap AS (
        SELECT c.test, r.api, n_a, n_b, n_both, round(CAST(n_both AS DOUBLE) / nullif(n_a, 0) * 100, 2) AS a_in_b_pct,
               round((CAST(n_b AS DOUBLE) / nullif(n_a, 0) - 1) * 100, 2) AS b_over_a_pct,
               round((CAST(n_a AS DOUBLE) / nullif(api, 0) - 1) * 100, 2) AS a_over_api_pct,
               round((CAST(n_b AS DOUBLE) / nullif(api, 0) - 1) * 100, 2) AS b_over_api_pct
        FROM counts c LEFT JOIN {reported} r ON c.test = r.test)"""


OVERLAP = _overlap()


@query("collection_overlap", f"{with_views('run_a', 'run_b', 'reported')}, {OVERLAP} SELECT * FROM overlap")
def _(spark, sf):
    return audit.collection_overlap(*_runs(spark, sf))


@query("missed_by_b", f"{with_views('run_a', 'run_b')} SELECT test, url FROM run_a EXCEPT SELECT test, url FROM run_b")
def _(spark, sf):
    first, second, _ = _runs(spark, sf)
    return audit.missed_by_second(first, second)


@query("undercount_bands", f"""{with_views('small_a', 'small_b', 'claimed')}, {_overlap('small_a', 'small_b', 'claimed')},
    banded AS (SELECT *, CASE WHEN api < 100 THEN '<100' WHEN api < 1000 THEN '100-1,000'
                              WHEN api < 7000 THEN '1,000-7,000' WHEN api >= 7000 THEN '>=7,000' END AS band FROM overlap)
    SELECT band, count(*) AS n_tests, min(b_over_api_pct) AS min_pct, max(b_over_api_pct) AS max_pct
    FROM banded GROUP BY band""")
def _(spark, sf):
    """Tests whose reported counts fall into every band, and some without a report."""
    return jobs.compare(*[view(spark, sf, name) for name in ("small_a", "small_b", "claimed")])["bands"]


@query("visible_narrow_only", f"""{with_views('hits')},
    seen AS (SELECT DISTINCT query, url, size_min, size_max FROM hits),
    r AS (SELECT DISTINCT query, size_min, size_max FROM hits)
    SELECT s.query, s.url, s.size_min, s.size_max, w.size_min AS wide_min, w.size_max AS wide_max
    FROM seen s JOIN r w ON s.query = w.query AND w.size_min <= s.size_min AND s.size_max <= w.size_max
         AND (w.size_min < s.size_min OR s.size_max < w.size_max)
    WHERE NOT EXISTS (SELECT 1 FROM seen t WHERE t.query = s.query AND t.url = s.url
                      AND t.size_min = w.size_min AND t.size_max = w.size_max)""")
def _(spark, sf):
    hits = view(spark, sf, "hits")
    ranged = F.concat(
        F.col("query"), F.lit(" size:"), F.col("size_min").cast("string"), F.lit(".."), F.col("size_max").cast("string")
    )
    return audit.visible_narrow_only(hits.withColumn("query", ranged))
