"""Plan checks over the registered queries: JVM-only expressions, no all-pairs joins,
column pruning at the scan."""

import pytest

import __spark_entry__ as entry
from conftest import SF001
from tidyspark.plans.catalog import QUERIES

PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                "FlatMapGroupsInPandas")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")
SKIP = {"csv_roundtrip", "parquet_roundtrip"}
NAMES = sorted(n for n in set(QUERIES) - SKIP if not n.startswith("pipeline_"))


@pytest.mark.parametrize("name", NAMES)
def test_query_plan(spark, name):
    df = entry.queries()[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PYTHON_NODES), name
    assert not any(n in plan for n in PAIR_NODES), name


def test_scan_reads_only_needed_columns(spark):
    df = entry.queries()["q1_count_distinct_by"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan


def test_pipeline_stages_have_no_pair_joins_or_python(spark, monkeypatch):
    import tidyspark.operators.keys as K
    import tidyspark.plans.survey as S
    from tidyspark.plans.pipeline import survey_inputs
    from tidyspark.sources.headers import normalize_headers
    bad, real = [], S.materialize

    def spy(df, label="stage"):
        plan = df._jdf.queryExecution().executedPlan().toString()
        bad.extend((label, n) for n in PYTHON_NODES + PAIR_NODES if n in plan)
        return real(df, label)

    monkeypatch.setattr(S, "materialize", spy)
    monkeypatch.setattr(K, "_materialize", spy)
    v, s = survey_inputs(spark, SF001)
    S.normalize_survey(spark, normalize_headers(v), normalize_headers(s))
    assert bad == []
