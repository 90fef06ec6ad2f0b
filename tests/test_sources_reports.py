"""Sources (PERMISSIVE CSV) and independence of reports/merges from input partitioning."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF01
from tidyspark.operators import reports
from tidyspark.operators.merge import merge_new_rows
from tidyspark.sources.headers import normalize_headers
from tidyspark.sources.tables import read_csv, read_table, write_report


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_permissive_keeps_malformed_rows(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Park ID,Total Time (min)\n1,30\n2,abc\n3,45\n")
    schema = T.StructType([T.StructField("Park ID", T.StringType()),
                           T.StructField("Total Time (min)", T.IntegerType())])
    df = normalize_headers(read_csv(spark, str(path), schema, normalize=False,
                                    corrupt_column="_corrupt_record"))
    rows = {r["ParkID"]: r for r in df.collect()}
    assert rows["1"]["TotalTimemin"] == 30 and rows["1"]["_corrupt_record"] is None
    assert rows["2"]["TotalTimemin"] is None and rows["2"]["_corrupt_record"] == "2,abc"


def test_read_table_missing_path_is_none(spark, tmp_path):
    assert read_table(spark, str(tmp_path / "nothing")) is None


def test_reports_do_not_depend_on_partitioning(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    sup = spark.read.parquet(f"{SF01}/supplier.parquet")
    a = reports.count_distinct_by(li.repartition(1), "l_suppkey", "l_partkey", "qty", sup,
                                  "s_suppkey", ["s_name"])
    b = reports.count_distinct_by(li.repartition(8), "l_suppkey", "l_partkey", "qty", sup,
                                  "s_suppkey", ["s_name"])
    assert _rows(a) == _rows(b)


def test_merge_does_not_depend_on_partitioning(spark):
    cust = spark.read.parquet(f"{SF01}/customer.parquet").select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("seg"))
    existing = spark.createDataFrame([(1, "Customer#000000007", None)],
                                     "id long, c_name string, seg string")
    batch = cust.select("c_name", "seg")
    a = merge_new_rows(existing, batch.repartition(1), ["c_name", "seg"], "id")
    b = merge_new_rows(existing, batch.repartition(8), ["c_name", "seg"], "id")
    assert _rows(a) == _rows(b)


def test_write_report_ordered_parts(spark, tmp_path):
    df = spark.read.parquet(f"{SF01}/nation.parquet").select("n_nationkey", "n_name")
    out = str(tmp_path / "rep")
    write_report(df, out, order_by=["n_nationkey"])
    back = spark.read.option("header", True).option("inferSchema", True).csv(out)
    assert sorted(r[0] for r in back.collect()) == list(range(25))


def test_csv_declared_schema_is_normalised(spark, tmp_path):
    path = tmp_path / "in2.csv"
    path.write_text("Park ID,Total Time (min)\n1,30\n")
    schema = T.StructType([T.StructField("Park ID", T.StringType()),
                           T.StructField("Total Time (min)", T.IntegerType())])
    df = read_csv(spark, str(path), schema)
    assert df.columns == ["ParkID", "TotalTimemin"] and df.first()["TotalTimemin"] == 30


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text("B,A\nx,1\ny,2\n")
    schema = T.StructType([T.StructField("A", T.IntegerType()), T.StructField("B", T.StringType())])
    assert _rows(read_csv(spark, str(path), schema)) == [(1, "x"), (2, "y")]
    absent = T.StructType([T.StructField("C", T.StringType())])
    try:
        read_csv(spark, str(path), absent)
        raise AssertionError("expected an error")
    except ValueError:
        pass


def test_first_load_that_died_leaves_no_table(spark, tmp_path):
    from tidyspark.sources.tables import merge_into_path
    folder = tmp_path / "store" / "names"
    folder.mkdir(parents=True)
    batch = spark.createDataFrame([("b",), ("a",)], "name string")
    assert read_table(spark, str(folder)) is None
    assert _rows(merge_into_path(spark, str(folder), batch, ["name"], "id")) == [(1, "a"), (2, "b")]


def test_literal_separators(spark):
    from tidyspark.operators import dims
    df = spark.createDataFrame([("ab", "cd|e"), (None, "f")], "x string, y string")
    got = dims.dim_from_columns(df, ["x", "y"], "name", "id", sep="|")
    assert [r[1] for r in sorted(got.collect())] == ["ab", "cd", "e", "f"]


def test_broadcast_hint_is_bounded_in_bytes(spark):
    from tidyspark.operators.facts import checked_broadcast
    wide = spark.range(3).select("id", F.repeat(F.lit("x"), 40_000_000).alias("name"))
    hinted = lambda d, n: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(checked_broadcast(spark.range(3).toDF("id"), 5), 5)
    assert not hinted(checked_broadcast(wide, 5), 5)
    assert not hinted(checked_broadcast(spark.range(9).toDF("id"), 5), 5)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import pytest
    from types import SimpleNamespace as N
    from tidyspark.session import ensure_checkpoint_dir
    sc = N(getCheckpointDir=lambda: None, getConf=lambda: {}, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(N(sparkContext=sc, conf={}))
