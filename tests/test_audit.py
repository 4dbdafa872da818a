from pyspark.sql import functions as F

from gleanery.operators import audit

# The published comparison of nine searches.
PUBLISHED = [
    ("zustand.config.js", 3, 2, 3, 50, 0),
    ("oxlint.config.json", 29, 22, 29, 32, 0),
    ("mise.local.toml", 101, 94, 101, 7, 0),
    ("knip.jsonc", 292, 318, 424, 33, 45),
    ("rsbuild.config.ts", 976, 3055, 3533, 16, 262),
    ("wrangler.toml", 2336, 13909, 42965, 209, 1739),
    ("vite.config.mts", 2376, 9029, 13279, 47, 459),
    ("auth.jsx", 4044, 20445, 64659, 216, 1499),
    ("tsup.config.ts", 6776, 9244, 41893, 353, 518),
]


def run(spark, column):
    sizes = spark.createDataFrame([(r[0], r[column]) for r in PUBLISHED], "test string, n long")
    return sizes.select("test", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("url")).withColumn("url", F.col("url").cast("string"))


def test_published_growth(spark):
    reported = spark.createDataFrame([(r[0], r[1]) for r in PUBLISHED], "test string, api long")
    overlap = audit.collection_overlap(run(spark, 2), run(spark, 3), reported)
    got = {r.test: r for r in overlap.collect()}
    for test, api, a, b, b_over_a, b_over_api in PUBLISHED:
        row = got[test]
        assert (row.api, row.n_a, row.n_b, row.n_both) == (api, a, b, min(a, b))
        assert round(row.b_over_a_pct) == b_over_a and round(row.b_over_api_pct) == b_over_api
    bands = {r.band: (r.n_tests, round(r.min_pct), round(r.max_pct)) for r in audit.undercount_bands(overlap).collect()}
    assert bands == {"<100": (2, 0, 0), "100-1,000": (3, 0, 262), "1,000-7,000": (4, 459, 1739)}


HITS = "query string, url string, size_min long, size_max long"


def test_multi_range_hits(spark):
    rows = [("q size:0..100", "u", 0, 100), ("q size:100..200", "u", 100, 200), ("q size:0..100", "u", 0, 100), ("q", "v", 0, 100), ("q", "v", None, 7)]
    got = audit.multi_range_hits(spark.createDataFrame(rows, HITS)).collect()
    assert [(r.url, r.range_count, r.ranges) for r in got] == [("u", 2, "0..100,100..200")]


def test_narrow_only(spark):
    rows = [
        ("filename:knip size:400..700", "hidden", 400, 700),
        ("filename:knip size:400..700", "seen", 400, 700),
        ("filename:knip size:0..10000", "seen", 0, 10000),
        ("filename:other size:0..10000", "x", 0, 10000),
    ]
    got = audit.visible_narrow_only(spark.createDataFrame(rows, HITS)).collect()
    assert [(r.query, r.url, r.size_min, r.wide_max) for r in got] == [("filename:knip", "hidden", 400, 10000)]


def test_telemetry_of_an_empty_log(spark):
    log = spark.createDataFrame([], "status int, started_at timestamp, elapsed_ms double")
    assert tuple(audit.request_telemetry(log).first()) == (0, 0, 0, 0.0, 0.0)


def test_history_summary(spark):
    rows = [("u", "2024-01-01", "a"), ("u", "2024-03-01", None), ("u", "2024-02-01", "a")]
    got = audit.history_summary(spark.createDataFrame(rows, "url string, date string, author string")).first()
    assert tuple(got) == ("u", "2024-01-01", "2024-03-01", 1, 3)


def test_outcome_counts(spark):
    rows = [("fetched", True), ("fetched", False), ("skipped", False), ("not_found", False), ("error", False), ("truncated_rest", False)]
    got = audit.outcome_counts(spark.createDataFrame(rows, "outcome string, is_hit boolean")).first()
    assert got.asDict() == {"fetched": 2, "skipped": 1, "not_found": 1, "errors": 1, "truncated_rest": 1, "pending": 0, "cache_hits": 1}
