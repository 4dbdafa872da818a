"""Operators that are to stay inside Spark's own functions."""

import pytest

from gleanery import llm

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_licenses", "op4_mixing", "op13_decontamination"])
def test_no_python_in_the_plan(spark, name):
    df = llm.all_queries()[name](spark, SF)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert "FileScan parquet" in plan
    for node in ("EvalPython", "InPandas", "InArrow", "ExistingRDD"):
        assert node not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
