"""Stored tables with versions: replace, concurrent merges, buckets, replayed batches, recovery."""

import threading

import pytest
from pyspark.sql import functions as F

from tidyspark.sources import store as S
from tidyspark.sources.files import create_if_absent, list_names, read_text


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _batch(spark, *names):
    return spark.createDataFrame([(n, len(n or "")) for n in names], "name string, size int")


def _table(spark, path, *names, buckets=0):
    t = S.StoredTable(spark, path, buckets)
    t.merge(_batch(spark, *names), "name", "id")
    return t


def test_create_if_absent_has_one_winner(spark, tmp_store):
    path, won = f"{tmp_store}/one", []
    threads = [threading.Thread(target=lambda i=i: won.append((create_if_absent(spark, path, f"text {i}"), i)))
               for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winners = [i for w, i in won if w]
    assert len(winners) == 1 and read_text(spark, path) == f"text {winners[0]}"
    assert list_names(spark, tmp_store) == ["one"]          # no drafts are left


def test_a_held_frame_reads_the_old_rows_after_a_replace(spark, tmp_store):
    t = _table(spark, tmp_store, "a", "b")
    held = t.read()
    t.replace(spark.createDataFrame([(9, "z", 1)], "id long, name string, size int"), "id")
    assert _rows(held) == [(1, "a", 1), (2, "b", 1)]
    assert _rows(t.read()) == [(9, "z", 1)] and _rows(t.read(1)) == _rows(held)
    t.merge(_batch(spark, "a", "z"), "name", "id")           # numbered after the replaced table's largest key
    assert _rows(t.read()) == [(10, "a", 1), (9, "z", 1)]


@pytest.mark.parametrize("what", ["replace", "merge"])
def test_a_writer_killed_before_it_publishes_changes_nothing(spark, tmp_store, what):
    t = _table(spark, tmp_store, "a", "b")

    def killed():
        raise KeyboardInterrupt
    with pytest.raises(KeyboardInterrupt):
        if what == "replace":
            t.replace(spark.createDataFrame([(9, "z", 1)], "id long, name string, size int"), "id",
                      before_publish=killed)
        else:
            t.merge(_batch(spark, "c"), "name", "id", before_publish=killed)
    assert _rows(t.read()) == [(1, "a", 1), (2, "b", 1)] and t.version().number == 1
    assert len(list_names(spark, f"{tmp_store}/data")) == 2
    assert t.clean(least_age=3600) == 0 and t.clean(least_age=0) == 1       # a young folder may be another writer's
    assert t.merge(_batch(spark, "c"), "name", "id") == 1
    assert _rows(t.read())[-1] == (3, "c", 1)


@pytest.mark.parametrize("buckets", [0, 4])
def test_a_merge_that_lost_compares_again_with_what_was_added(spark, tmp_store, buckets):
    t = _table(spark, tmp_store, "a", None, buckets=buckets)
    other = S.StoredTable(spark, tmp_store)
    n = t.merge(_batch(spark, "a", "c", "d", None), "name", "id",
                before_publish=lambda: other.merge(_batch(spark, "b", "c"), "name", "id"))
    assert n == 1
    assert _rows(t.read()) == [(1, None, 0), (2, "a", 1), (3, "b", 1), (4, "c", 1), (5, "d", 1)]


def test_a_merge_that_lost_to_a_replace_compares_with_the_new_rows(spark, tmp_store):
    t = _table(spark, tmp_store, "a", "b")
    new = spark.createDataFrame([(7, "c", 1)], "id long, name string, size int")
    n = t.merge(_batch(spark, "a", "c", "e"), "name", "id", before_publish=lambda: t.replace(new, "id"))
    assert n == 2 and _rows(t.read()) == [(7, "c", 1), (8, "a", 1), (9, "e", 1)]


def test_merges_in_threads_store_no_key_twice(spark, tmp_store):
    _table(spark, tmp_store, "n0")
    names = [[f"n{i}" for i in range(k, k + 6)] for k in range(0, 12, 3)]
    threads = [threading.Thread(target=lambda b=b: S.StoredTable(spark, tmp_store).merge(
        _batch(spark, *b), "name", "id")) for b in names]
    for th in threads:
        th.start()
    for th in threads:
        th.join()
    rows = S.StoredTable(spark, tmp_store).read()
    n = len({x for b in names for x in b})
    assert tuple(rows.agg(F.count("*"), F.countDistinct("name"), F.countDistinct("id"), F.max("id")).first()) == (n,) * 4


def test_a_merge_reads_only_the_buckets_of_its_batch(spark, tmp_store):
    names = [f"n{i}" for i in range(200)]
    plain = _table(spark, f"{tmp_store}/plain", *names)
    t = _table(spark, f"{tmp_store}/buckets", *names, buckets=16)
    batch = _batch(spark, "n5", "new").withColumn("size", F.col("size").cast("int"))
    v = t.version()
    known = t._known(v, v.folders, batch, ["name"])
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__bucket" in plan or "__bucket" in plan.split("PartitionFilters")[1][:80]
    assert len({f.split("__bucket=")[1].split("/")[0] for f in known.select("name", F.input_file_name().alias("f"))
                .toPandas()["f"]}) <= 2
    assert t.merge(batch, "name", "id") == plain.merge(batch, "name", "id") == 1
    assert _rows(t.read()) == _rows(plain.read())
    with pytest.raises(ValueError, match="in buckets by"):
        t.merge(batch, ["name", "size"], "id")


def test_a_replayed_batch_is_known_without_reading_stored_rows(spark, tmp_store, monkeypatch):
    t = _table(spark, tmp_store, "a")
    assert t.merge(_batch(spark, "b"), "name", "id", sequence="s", batch_number=0) == 1
    assert t.merge(_batch(spark, "a"), "name", "id", sequence="s", batch_number=1) == 0      # nothing new, but seen
    assert t.version().batches == {"s": 1}

    def no_read(*_):
        raise AssertionError("stored rows were read")
    monkeypatch.setattr(S.StoredTable, "_known", no_read)
    monkeypatch.setattr(S.StoredTable, "_rows", no_read)
    for number in (0, 1):
        assert t.merge(_batch(spark, "x"), "name", "id", sequence="s", batch_number=number) == 0
    monkeypatch.undo()
    assert t.merge(_batch(spark, "x"), "name", "id", sequence="other", batch_number=0) == 1
    assert _rows(t.read()) == [(1, "a", 1), (2, "b", 1), (3, "x", 1)]


def test_compact_and_clean_keep_rows_and_keys(spark, tmp_store):
    t = _table(spark, tmp_store, "b")
    for n in "adc":
        t.merge(_batch(spark, n), "name", "id")
    before = _rows(t.read())
    t.compact("id")
    assert len(t.version().folders) == 1 and _rows(t.read()) == before
    assert t.clean(keep=1, least_age=0) == 4 and _rows(t.read()) == before
    assert t.merge(_batch(spark, "e"), "name", "id") == 1 and _rows(t.read())[-1] == (5, "e", 1)


def test_empty_tables(spark, tmp_store):
    t = S.StoredTable(spark, tmp_store)
    assert t.read() is None and t.merge(_batch(spark), "name", "id") == 0
    assert _rows(t.read()) == [] and t.read().columns == ["id", "name", "size"]
    assert t.merge(_batch(spark, "a", "a"), "name", "id") == 1 and _rows(t.read()) == [(1, "a", 1)]
