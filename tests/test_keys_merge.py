"""dense_key and merge_new_rows: exactness, NULLs, idempotence, partition independence, plans."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF01
from tidyspark.operators.keys import dense_key
from tidyspark.operators.merge import merge_new_rows, new_rows


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_dense_key_matches_row_number_many_buckets(spark, many_partitions):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    got = dense_key(li, order, "k", start=7)
    want = li.withColumn("k", F.row_number().over(Window.orderBy(*order)) + 7)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    ks = got.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first()
    assert tuple(ks) == (8, 7 + li.count(), li.count())


def test_dense_key_nulls_first_and_ties_broken(spark, many_partitions):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    rows = [(None, 3), ("x", 2), (None, 1), ("a", 5), ("x", 1), ("a", None)] * 50
    rows = [(a, None if b is None else b + i) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(rows, schema)
    got = dense_key(df, ["a"], "k")      # many buckets, ties on a
    want = df.withColumn("k", F.row_number().over(Window.orderBy("a", "b")))
    assert _rows(got) == _rows(want)


def test_dense_key_independent_of_partitioning(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_orderdate")
    a = dense_key(o.repartition(1), ["o_orderdate"], "k")
    b = dense_key(o.repartition(13), ["o_orderdate"], "k")
    assert _rows(a) == _rows(b)


def test_dense_key_empty_and_single(spark):
    empty = spark.createDataFrame([], "x string")
    assert dense_key(empty, ["x"], "k").count() == 0
    one = spark.createDataFrame([("a",)], "x string")
    assert _rows(dense_key(one, ["x"], "k", start=41)) == [("a", 42)]


def test_dense_key_plans_have_no_single_partition_exchange(spark, monkeypatch, many_partitions):
    from tidyspark.operators import keys
    plans, real = [], keys._materialize

    def spy(df, label="stage"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(keys, "_materialize", spy)
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    df = dense_key(li, ["l_orderkey", "l_linenumber"], "k")
    plans.append(df._jdf.queryExecution().executedPlan().toString())
    assert not any(x in p for p in plans for x in ("SinglePartition", "Window", "PythonUDF"))
    assert sum("rangepartitioning" in p for p in plans) == 1      # the only exchange of rows
    assert "Exchange rangepartitioning" not in plans[-1] and "hashpartitioning" not in plans[-1]


def test_dense_key_does_not_depend_on_how_its_files_are_split(spark):
    df = spark.range(20_000).select((F.col("id") % 7).cast("int").alias("a"))
    old = spark.conf.get("spark.sql.files.minPartitionNum", None)
    got = dense_key(df, ["a"], "k")
    try:
        spark.conf.set("spark.sql.files.minPartitionNum", "61")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        r = got.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.minPartitionNum", old) if old else spark.conf.unset(
            "spark.sql.files.minPartitionNum")
    assert tuple(r) == (1, 20_000, 20_000)


def _merge_inputs(spark):
    src = spark.read.parquet(f"{SF01}/customer.parquet").select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("seg"))
    existing = dense_key(src.where(F.col("c_custkey") % 2 == 0).select("c_name", "seg"),
                         ["c_name", "seg"], "id").select("id", "c_name", "seg")
    return existing, src.select("c_name", "seg")


def test_merge_is_idempotent_and_keeps_known_keys(spark):
    existing, batch = _merge_inputs(spark)
    once = merge_new_rows(existing, batch, ["c_name", "seg"], "id")
    twice = merge_new_rows(once, batch, ["c_name", "seg"], "id")
    assert _rows(once) == _rows(twice)
    assert existing.exceptAll(once).count() == 0            # stored rows unchanged
    n = batch.count()
    assert tuple(once.agg(F.count("*"), F.countDistinct("id"), F.max("id")).first()) == (n, n, n)


def test_merge_null_key_matches_null_safely(spark):
    existing = spark.createDataFrame([(1, None, "a"), (2, "x", None)], "id long, k1 string, k2 string")
    batch = spark.createDataFrame([(None, "a"), ("x", None), (None, None)], "k1 string, k2 string")
    out = merge_new_rows(existing, batch, ["k1", "k2"], "id")
    assert _rows(out) == [(1, None, "a"), (2, "x", None), (3, None, None)]
    assert _rows(merge_new_rows(out, batch, ["k1", "k2"], "id")) == _rows(out)


def test_merge_first_load_and_empty_batch(spark):
    batch = spark.createDataFrame([("b",), ("a",), ("b",)], "name string")
    first = merge_new_rows(None, batch, ["name"], "id")
    assert _rows(first) == [(1, "a"), (2, "b")]
    empty = spark.createDataFrame([], "name string")
    assert _rows(merge_new_rows(first, empty, ["name"], "id")) == _rows(first)


def test_new_rows_dedupes_hot_key_deterministically(spark):
    batch = spark.createDataFrame([("k", 3), ("k", 1), ("k", 2)] * 100, "nk string, v int")
    assert _rows(new_rows(None, batch, ["nk"])) == [("k", 1)]


def test_merge_plan_is_null_safe_anti_join(spark):
    existing, batch = _merge_inputs(spark)
    fresh = new_rows(existing, batch, ["c_name", "seg"])
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_small_batch_does_not_shuffle_the_stored_table(spark):
    stored = spark.read.parquet(f"{SF01}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    batch = stored.limit(5).union(spark.createDataFrame([(-1, 1), (None, 2)], stored.schema))
    fresh = new_rows(stored, batch, ["l_orderkey", "l_linenumber"])
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    scan = plan[:plan.index("lineitem.parquet")]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "LeftSemi" in scan and "hashpartitioning" not in scan[scan.index("LeftSemi"):]
    assert _rows(fresh) == _rows(batch.where("l_orderkey is null or l_orderkey = -1"))


def test_large_batch_gives_the_same(spark, monkeypatch):
    from tidyspark.operators import merge
    existing, batch = _merge_inputs(spark)
    small = _rows(new_rows(existing, batch, ["c_name", "seg"]))
    monkeypatch.setattr(merge, "BROADCAST_ROWS", 3)
    assert _rows(new_rows(existing, batch, ["c_name", "seg"])) == small


def test_dense_key_splits_a_hot_group_of_copies(spark, many_partitions):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select("l_returnflag", "l_linestatus")
    hot = li.where("l_returnflag <> 'A'").select(F.lit("HOT").alias("l_returnflag"),
                                                F.lit("X").alias("l_linestatus"))
    df = li.unionByName(hot)            # about 40% of the rows are one copy group
    got = dense_key(df, ["l_returnflag", "l_linestatus"], "k")
    n = df.count()
    assert tuple(got.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first()) == (1, n, n)
    want = df.withColumn("k", F.row_number().over(Window.orderBy("l_returnflag", "l_linestatus")))
    # copies are interchangeable: compare the (row, key) multisets per tuple range
    g = got.groupBy("l_returnflag", "l_linestatus").agg(F.min("k"), F.max("k"), F.count("*"))
    w = want.groupBy("l_returnflag", "l_linestatus").agg(F.min("k"), F.max("k"), F.count("*"))
    assert _rows(g) == _rows(w)
    assert hot.count() > n // 3
    # the group of copies was written by several tasks
    files = got.where("l_returnflag = 'HOT'").select(F.input_file_name()).distinct().count()
    assert files > 1
