"""foreachBatch merge equals the batch merge, and replaying input adds nothing."""

from pyspark.sql import functions as F

from conftest import SF001
from tidyspark.operators.merge import merge_new_rows
from tidyspark.sources.tables import read_table
from tidyspark.sources.store import StoredTable
from tidyspark.streaming.incremental import merge_stream, merge_stream_into


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stream_merge_matches_batch_merge(spark, tmp_path):
    cust = spark.read.parquet(f"{SF001}/customer.parquet").select(
        "c_name", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("segment"))
    src = str(tmp_path / "incoming")
    cust.where("c_name < 'Customer#000000080'").write.parquet(f"{src}/part=1")
    cust.write.mode("append").parquet(f"{src}/part=2")       # overlaps part 1
    target = str(tmp_path / "table")
    stream = (spark.readStream.schema("c_name string, segment string")
              .option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src))
    q = merge_stream(stream, target, ["c_name", "segment"], "cust_id",
                     checkpoint_location=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    stored = read_table(spark, target)
    expected = merge_new_rows(None, cust, ["c_name", "segment"], "cust_id")
    assert stored.count() == cust.count()
    assert stored.select("c_name", "segment").exceptAll(expected.select("c_name", "segment")).count() == 0
    ids = stored.agg(F.min("cust_id"), F.max("cust_id"), F.countDistinct("cust_id")).first()
    assert tuple(ids) == (1, cust.count(), cust.count())
    # a second run over the same files (fresh checkpoint = full replay) adds nothing
    q2 = merge_stream(stream, target, ["c_name", "segment"], "cust_id",
                      checkpoint_location=str(tmp_path / "ckpt2"))
    q2.awaitTermination(300)
    assert _rows(read_table(spark, target)) == _rows(stored)


def test_a_replayed_stream_is_known_by_its_batch_numbers(spark, tmp_path, monkeypatch):
    cust = spark.read.parquet(f"{SF001}/customer.parquet").select("c_name", "c_mktsegment")
    src = str(tmp_path / "incoming")
    cust.where("c_name < 'Customer#000000080'").write.parquet(f"{src}/part=1")
    cust.write.mode("append").parquet(f"{src}/part=2")
    table = StoredTable(spark, str(tmp_path / "table"), buckets=4)
    stream = (spark.readStream.schema("c_name string, c_mktsegment string")
              .option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src))

    def run(checkpoint):
        merge_stream_into(stream, table, "c_name", "id", sequence="customers",
                          checkpoint_location=str(tmp_path / checkpoint)).awaitTermination(300)
    run("ckpt")
    stored, version = _rows(table.read()), table.version()
    assert len(stored) == cust.count() and [r[0] for r in sorted(stored)] == list(range(1, len(stored) + 1))
    assert version.batches["customers"] >= 1

    def no_scan(*_):
        raise AssertionError("stored keys were read")
    monkeypatch.setattr(StoredTable, "_known", no_scan)
    run("another")                     # the same batches again, with the same numbers
    monkeypatch.undo()
    assert table.version() == version and _rows(table.read()) == stored
