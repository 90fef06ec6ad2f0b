"""Skew-aware lookup, exact top k, maintained counts, enforcing writes."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidyspark.operators import facts, reports
from tidyspark.operators.audit import audit
from tidyspark.operators.enforce import enforce
from tidyspark.operators.maintained import MaintainedCounts
from tidyspark.specs import TableSpec, fk


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_lookup_spread_leaves_a_heavy_value_where_it_is(spark):
    fact = spark.range(0, 40_000, 1, 8).select("id", F.when(F.col("id") % 2 == 0, F.lit("hot")).when(
        F.col("id") % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("v"), F.col("id") % 900)).alias("name"))
    dim = spark.createDataFrame([(f"v{i}", i) for i in range(800)] + [("hot", 9000), (None, 1)], "name string, key int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = facts.lookup_spread(fact, dim, "name", "name", "key")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        tasks = (got.where("name = 'hot'").groupBy(F.spark_partition_id()).count().collect())
        assert len(tasks) == 8 and {r["count"] for r in tasks} == {2500}
        want = facts.lookup(fact, dim, "name", "name", "key")
        assert _rows(got.select("id", "name", "key")) == _rows(want.select("id", "name", "key"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert facts.heavy_hashes(fact.where("false"), "name") == []
    assert facts.lookup_spread(fact.where("false"), dim, "name", "name", "key").count() == 0


@pytest.mark.parametrize("kind", ["skewed", "flat", "few", "ties", "empty"])
def test_top_by_frequency_equals_the_full_rank(spark, kind):
    rnd = random.Random(2)
    values = {"skewed": [f"w{int(rnd.paretovariate(0.7))}" for _ in range(60_000)],
              "flat": [f"w{i % 20_000}" for i in range(60_000)], "few": ["a", "b", None, "b"],
              "ties": [f"t{i % 30:02d}" for i in range(9_000)] + [f"x{i}" for i in range(20_000)], "empty": []}[kind]
    df = spark.createDataFrame([(v,) for v in values], "w string").repartition(5)
    for k in (1, 10, 40):
        got = [tuple(r) for r in reports.top_by_frequency(df, "w", k).collect()]
        best = sorted(Counter(values).items(), key=lambda x: (-x[1], x[0] is None, x[0] or ""))[:k]
        assert got == [(i + 1, w, n) for i, (w, n) in enumerate(best)]


def test_top_by_frequency_counts_only_survivors(spark, monkeypatch):
    df = spark.createDataFrame([(f"w{i % 5}" if i % 2 else f"r{i}",) for i in range(50_000)], "w string")
    counted = []
    real = type(df).groupBy

    def spy(self, *cols):
        if cols:                                                       # a plain agg() groups by nothing
            counted.append(self.count())
        return real(self, *cols)
    monkeypatch.setattr(type(df), "groupBy", spy)
    assert len(reports.top_by_frequency(df, "w", 5).collect()) == 5
    assert counted == [25_000]                                           # the rare words are not


def test_maintained_counts_follow_batches(spark, tmp_store):
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([*range(30), None])) for _ in range(400)]
    counts = MaintainedCounts(spark, tmp_store, "g", "m", buckets=4)
    assert counts.report() is None
    seen = set()
    for part in (rows[:150], rows[100:300], [], rows[:50], rows[250:]):
        new = counts.update(spark.createDataFrame(part, "g string, m int"))
        assert new == len(set(part) - seen)
        seen |= set(part)
        assert {r.g: r.qty for r in counts.report().collect()} == Counter(g for g, _ in seen)


def test_maintained_counts_make_up_for_an_update_that_ended_halfway(spark, tmp_store, monkeypatch):
    counts = MaintainedCounts(spark, tmp_store, "g", "m", buckets=2)
    counts.update(spark.createDataFrame([("a", 1)], "g string, m int"))
    monkeypatch.setattr(MaintainedCounts, "catch_up", lambda self: None)
    counts.update(spark.createDataFrame([("a", 2), ("b", 1)], "g string, m int"))
    monkeypatch.undo()
    assert _rows(counts.report()) == [("a", 1)]
    counts.catch_up()
    counts.catch_up()
    assert _rows(counts.report()) == [("a", 2), ("b", 1)]


def _model(spark):
    parents = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c"), (None, "d"), (3, "too long"), (4, None)],
                                    "id int, name string")
    children = spark.createDataFrame([(10, 1), (11, 2), (12, 3), (13, None), (14, 9), (15, 4), (15, 4)],
                                     "cid int, parent int")
    specs = [TableSpec("children", primary_key=("cid",), foreign_keys=(fk("parent", "parents", "id"),)),
             TableSpec("parents", primary_key=("id",), not_null=("id",), max_length={"name": 4})]
    return {"parents": parents, "children": children, "other": parents}, specs


def test_enforce_splits_every_row(spark):
    tables, specs = _model(spark)
    clean, quarantine = enforce(tables, specs)
    assert _rows(clean["parents"]) == [(1, "a"), (2, "c"), (4, None)]
    assert _rows(clean["children"]) == [(10, 1), (11, 2), (13, None), (15, 4)]
    assert clean["other"] is tables["other"]
    assert _rows(quarantine) == [
        ("children", "foreign_key", "parent", '{"cid":12,"parent":3}'),        # its parent was too long
        ("children", "foreign_key", "parent", '{"cid":14,"parent":9}'),
        ("children", "primary_key", "cid", '{"cid":15,"parent":4}'),
        ("parents", "max_length", "name", '{"id":3,"name":"too long"}'),
        ("parents", "not_null", "id", '{"id":null,"name":"d"}'),
        ("parents", "primary_key", "id", '{"id":1,"name":"b"}'),
        ("parents", "primary_key", "id", '{"id":2,"name":"c"}')]
    assert audit({k: clean[k] for k in ("parents", "children")}, specs).where("violations > 0").count() == 0


def test_enforce_refuses_circles(spark):
    tables, specs = _model(spark)
    circle = TableSpec("parents", primary_key=("id",), foreign_keys=(fk("id", "children", "cid"),))
    with pytest.raises(ValueError, match="refer to each other"):
        enforce(tables, [specs[0], circle])
