"""CSV reading that rejects instead of losing: every line is a row or a reject with a reason.

``read_csv_checked`` splits lines itself, with built-in expressions, so it sees
what a tolerant reader drops: fields beyond the header, fields that are missing,
quotes that are never closed or have text behind them, values that are not of
their declared type. A line becomes a typed row only if none of this holds; any
other line is kept whole, with its file, its number in the file and the reason.

Lines end at a line break, also inside quotes: a quoted field that goes over a
break is two rejected lines. Fields are separated by ``sep``; a field in
quotes may hold it, and two quotes for one. An empty field is NULL, an empty
quoted one is an empty text.

The lines are read and split once, into a table below the checkpoint folder; accepted and
rejected rows and line numbers all come from that table. A line's number is its
place in its part of the file plus the lines of the parts before, so no task reads
a whole file.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.operators.facts import checked_broadcast
from tidyspark.session import materialize

MOST_PARTS = 500_000           # file parts whose line counts are broadcast; more are joined


@dataclass(frozen=True)
class CheckedCsv:
    """``accepted``: typed rows with ``file`` and ``line``; ``rejected``: (file, line, raw, reason)."""

    accepted: DataFrame
    rejected: DataFrame

    def rows(self) -> DataFrame:
        return self.accepted.drop("__file", "__line")


def _patterns(sep: str) -> tuple[str, str]:
    """A line of well-formed fields, each with the separator before it, and one such field."""
    s = re.escape(sep)
    field = f'{s}(?:"(?:[^"]++|"")*+"(?={s}|$)|(?!")(?:(?!{s}).)*+)'
    return f"(?s)^(?:{field})++$", f"(?s){field}"


def _value(field: Column, sep: str) -> Column:
    """A field without its separator and quotes; NULL if it is empty."""
    text = F.substr(field, F.lit(len(sep) + 1))
    quoted = text.startswith('"')
    inner = F.replace(F.substr(text, F.lit(2), F.char_length(text) - 2), F.lit('""'), F.lit('"'))
    return F.when(quoted, inner).otherwise(F.nullif(text, F.lit("")))


def _numbered_lines(spark: SparkSession, path, sep: str) -> DataFrame:
    """(file, part, place, raw, whole, fields) of all lines, written once; ``place`` counts within a part."""
    whole, field = _patterns(sep)
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("raw"))
    led = F.concat(F.lit(sep), "raw")
    return materialize(lines.select("*", led.rlike(whole).alias("whole"), F.regexp_extract_all(led, F.lit(field), 0)
                                    .alias("fields")), "csv-lines")


def read_csv_checked(spark: SparkSession, path: str | list[str], schema: T.StructType, *, header: bool = True,
                     sep: str = ",") -> CheckedCsv:
    """Rows of ``schema`` and rejects. With ``header`` the first line of every file names the columns.

    Columns are bound by their raw header names in any order; columns the schema does not have are
    left out but must be there in every line. All files must have the same header.
    """
    lines = _numbered_lines(spark, path, sep)
    per_part = lines.groupBy("file", "part").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("part")) - F.col("n")
    parts = checked_broadcast(materialize(per_part.select("file", "part", "first", before.alias("before")),
                                          "csv-parts"), MOST_PARTS)
    # lines of one part are read in one task, one after the other
    numbered = (lines.join(parts, ["file", "part"])
                .select("file", (F.col("before") + F.col("id") - F.col("first") + 1).alias("line"), "raw", "whole",
                        "fields"))
    names = [f.name for f in schema.fields]
    if header:
        names = _header(numbered, sep)
        absent = [f.name for f in schema.fields if f.name not in names]
        if absent and names:
            raise ValueError(f"the header lacks {absent}")
        numbered = numbered.where("line > 1")
    names = names or [f.name for f in schema.fields]

    values = {f.name: _value(F.get("fields", F.lit(names.index(f.name))), sep) for f in schema.fields}
    typed = {f.name: values[f.name].try_cast(f.dataType) for f in schema.fields}
    wrong = [F.when(values[f.name].isNotNull() & typed[f.name].isNull(),
                    F.lit(f"{f.name} is not {f.dataType.simpleString()}")) for f in schema.fields]
    n = F.size("fields")
    reason = F.coalesce(
        F.when(~F.col("whole"), F.lit("open quote")),
        F.when((F.col("raw") == "") & F.lit(len(names) > 1), F.lit("empty line")),
        F.when(n > len(names), F.lit("surplus fields")), F.when(n < len(names), F.lit("missing fields")),
        *wrong)
    judged = numbered.withColumn("reason", reason)
    accepted = judged.where("reason IS NULL").select(
        *[typed[f.name].alias(f.name) for f in schema.fields], F.col("file").alias("__file"), F.col("line").alias("__line"))
    return CheckedCsv(accepted, judged.where("reason IS NOT NULL").select("file", "line", "raw", "reason"))


def _header(numbered: DataFrame, sep: str) -> list[str]:
    """The column names; an error if files differ or the line is damaged."""
    field = F.regexp_replace(F.col("raw"), "^﻿", "")
    first = numbered.where("line = 1").select(field.alias("raw"), "whole").distinct().limit(3).collect()
    if not first:
        return []
    if len(first) > 1:
        raise ValueError(f"files have different headers, e.g. {first[0].raw!r} and {first[1].raw!r}")
    if not first[0].whole:
        raise ValueError(f"the header has an open quote: {first[0].raw!r}")
    quoted = re.compile(_patterns(sep)[1].replace("++", "+").replace("*+", "*"))
    out = [m.group(0)[len(sep):] for m in quoted.finditer(sep + first[0].raw)]
    return [x[1:-1].replace('""', '"') if x.startswith('"') else x for x in out]


def counted(checked: CheckedCsv) -> DataFrame:
    """Lines by outcome: ``accepted`` or the reason."""
    parts = [checked.accepted.select(F.lit("accepted").alias("outcome")), checked.rejected.select(
        F.col("reason").alias("outcome"))]
    return reduce(DataFrame.unionByName, parts).groupBy("outcome").agg(F.count(F.lit(1)).alias("lines"))
