"""Damaged CSV: accepted and rejected lines together are all lines."""

import pathlib

import pytest
from pyspark.sql import types as T

from tidyspark.sources.checked import counted, read_csv_checked
from tidyspark.sources.tables import read_csv

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                       T.StructField("day", T.DateType())])
LINES = ["name,id,day", "a,1,2024-01-02", '"b, ""x""",2,2024-01-03', "c,3,2024-01-04,LOST", "d,4", "", 'e,"5,2024-01-05',
         'f,"6"7,2024-01-06', "g,seven,2024-01-07", "h,8,someday", ",9,", '"",10,2024-01-08', 'i"j,11,2024-01-09']


def _write(folder, name, lines):
    p = pathlib.Path(folder) / name
    p.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(p)


def test_every_line_is_accepted_or_rejected(spark, tmp_store):
    path = _write(tmp_store, "a.csv", LINES)
    got = read_csv_checked(spark, path, SCHEMA)
    rows = {r["__line"]: (r.id, r.name, str(r.day) if r.day else None) for r in got.accepted.collect()}
    assert rows == {2: (1, "a", "2024-01-02"), 3: (2, 'b, "x"', "2024-01-03"), 11: (9, None, None),
                    12: (10, "", "2024-01-08"), 13: (11, 'i"j', "2024-01-09")}
    rejects = {r.line: (r.raw, r.reason) for r in got.rejected.collect()}
    assert rejects == {n: (LINES[n - 1], reason) for n, reason in {
        4: "surplus fields", 5: "missing fields", 6: "empty line", 7: "open quote", 8: "open quote",
        9: "id is not int", 10: "day is not date"}.items()}
    assert len(rows) + len(rejects) == len(LINES) - 1
    assert {r.outcome: r.lines for r in counted(got).collect()}["accepted"] == 5


def test_line_numbers_over_parts_and_files(spark, tmp_store):
    body = [f"n{i},{i},2024-01-01" if i % 7 else f"n{i},{i}" for i in range(2, 5002)]
    for name in ("a.csv", "b.csv"):
        _write(tmp_store, name, ["name,id,day", *body])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        got = read_csv_checked(spark, tmp_store, SCHEMA)
        assert got.accepted.where("__line <> id").count() == 0
        assert got.rejected.where("raw NOT LIKE concat('n', line, ',%')").count() == 0
        assert got.accepted.count() + got.rejected.count() == 10_000
        assert got.rejected.select("file").distinct().count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_headers(spark, tmp_store):
    one = _write(tmp_store, "a.csv", ["﻿id,name,day", "1,a,2024-01-01"])
    assert read_csv_checked(spark, one, SCHEMA).rows().first().id == 1
    with pytest.raises(ValueError, match="lacks .'day'"):
        read_csv_checked(spark, _write(tmp_store, "b.csv", ["id,name", "1,a"]), SCHEMA)
    with pytest.raises(ValueError, match="different headers"):
        read_csv_checked(spark, [one, _write(tmp_store, "c.csv", ["name,id,day"])], SCHEMA)
    none = read_csv_checked(spark, _write(tmp_store, "d.csv", ["1;a;2024-01-01", "2;b"]), SCHEMA, header=False, sep=";")
    assert [r.id for r in none.rows().collect()] == [1] and [r.line for r in none.rejected.collect()] == [2]
    empty = pathlib.Path(tmp_store) / "e.csv"
    empty.write_text("")
    got = read_csv_checked(spark, str(empty), SCHEMA)
    assert got.rows().count() == got.rejected.count() == 0


def test_long_fields(spark, tmp_store):
    text = "x" * 2_000_000
    path = _write(tmp_store, "a.csv", ["name,id,day", f"{text},1,", '"' + 'y""' * 300_000 + '",2,', '"' + text + ",3,"])
    got = read_csv_checked(spark, path, SCHEMA)
    assert {r.id: len(r.name) for r in got.rows().collect()} == {1: 2_000_000, 2: 600_000}
    assert [(r.line, r.reason) for r in got.rejected.collect()] == [(4, "open quote")]


def test_tolerant_reader_keeps_surplus_and_missing_fields_in_the_corrupt_column(spark, tmp_store):
    path = _write(tmp_store, "a.csv", ["id,name", "1,a", "2,b,LOST", "3", "x,d"])
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    df = read_csv(spark, path, schema, corrupt_column="raw")
    assert [tuple(r) for r in df.collect()] == [(1, "a", None), (2, "b", "2,b,LOST"), (3, None, "3"), (None, "d", "x,d")]
    assert [r.raw for r in df.select("raw").collect()] == [None, "2,b,LOST", "3", "x,d"]
