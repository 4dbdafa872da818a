import re

from gleanery.sources import response_log

LOG = "request_id long, body string"
PATHS = {"n": ("$.a.n", "bigint"), "name": ("$.a.name", "string")}


def test_paths_of_shredded_bodies(spark, tmp_path):
    rows = [(1, '{"a":{"n":1,"name":"x","long":"unread"}}'), (2, '{"a":{"n":"two"}}'), (3, ""), (4, None), (5, "no json"),
            (6, '{"a":null}'), (7, '{"a":{"n":1,"name":"x","long":"unread"}}'), (None, '{"a":{"n":8}}')]
    folder = str(tmp_path / "log")
    response_log.write_log(spark.createDataFrame(rows, LOG), folder)
    response_log.write_log(spark.createDataFrame([(9, '{"a":{"n":9}}')], LOG), folder)
    got = {r.request_id: (r.n, r.name) for r in response_log.read_paths(spark, folder, PATHS, "request_id").collect()}
    none = (None, None)
    assert got == {1: (1, "x"), 2: none, 3: none, 4: none, 5: none, 6: none, 7: (1, "x"), None: (8, None), 9: (9, None)}
    assert spark.conf.get("spark.sql.variant.writeShredding.enabled") == response_log_default(spark)


def response_log_default(spark):
    return spark.newSession().conf.get("spark.sql.variant.writeShredding.enabled")


def test_an_empty_log(spark, tmp_path):
    response_log.write_log(spark.createDataFrame([], LOG), str(tmp_path / "log"))
    assert response_log.read_paths(spark, str(tmp_path / "log"), PATHS, "request_id").collect() == []


def test_other_fields_are_not_read(spark, plan_of, tmp_path):
    folder = str(tmp_path / "log")
    response_log.write_log(spark.createDataFrame([(1, '{"a":{"n":1,"name":"x","long":"unread"}}')], LOG), folder)
    spark.conf.set("spark.sql.variant.pushVariantIntoScan", "true")
    try:
        plan = plan_of(response_log.read_paths(spark, folder, {"n": PATHS["n"]}, "request_id"))
    finally:
        spark.conf.unset("spark.sql.variant.pushVariantIntoScan")
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "body:struct<0:bigint>" in schema and "variant" not in schema
