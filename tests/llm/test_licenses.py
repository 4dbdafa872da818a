import duckdb
import pytest
from pyspark.sql import functions as F

from gleanery.llm.licenses import TEMPLATES, scan, shingles_of
from gleanery.llm.queries import CHECKS, QUERIES

LONG = [name for name, text in TEMPLATES.items() if len(shingles_of(text)) >= 12]


def both(spark, docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    want = con.execute(CHECKS["op1_licenses"]).fetchall()
    got = scan(docs.select("doc_id", "text")).select("doc_id", "license", "containment", "n_found", "n_shingles").collect()
    return sorted(map(tuple, got)), sorted(want)


def test_planted_copies(spark):
    """Every template at eight offsets, whole, and with one end or two words changed."""
    rows = []
    for k, (name, text) in enumerate(TEMPLATES.items()):
        for shift in range(8):
            filler = " ".join(f"w{i}" for i in range(40 + shift))
            rows.append((len(rows), f"{filler}\n{text.upper()} {filler}"))
        words = text.split()
        rows.append((len(rows), " ".join([*words[:-1], "changed", *words[:3]])))
        if name in LONG:
            rows.append((len(rows), " ".join(words[:3] + ["new"] + words[4:])))
    got, want = both(spark, spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got == want and {r[1] for r in got} == set(TEMPLATES)


def test_query_matches_sql(spark, sf, documents):
    got, want = both(spark, documents)
    assert got == want and got
    assert QUERIES["op1_licenses"](spark, sf).count() == len(got)


def test_plan_is_native_and_moves_nothing(spark, sf, plan_of):
    plan = plan_of(QUERIES["op1_licenses"](spark, sf))
    assert "Python" not in plan and "ArrowEval" not in plan and " Exchange" not in plan


def test_odd_rows(odd, none, spark):
    notice = "Released under the MIT License."
    docs = odd.withColumn("License", F.lit(1)).unionByName(
        spark.createDataFrame([(20, notice, "en", "a", 1, 1), (20, notice, "en", "a", 1, 1), (21, "mit license", "en", "a", 1, 1)],
                              "doc_id bigint, text string, lang string, source string, n_chars bigint, License int"))
    rows = scan(docs).collect()
    assert [(r.doc_id, r.license, r.containment) for r in rows] == [(20, "mit-notice", 1.0)] * 2
    assert scan(none).collect() == []
    with pytest.raises(ValueError):
        scan(odd, {"short": "mit"})
