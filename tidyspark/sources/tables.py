"""Readers and writers: CSV with declared schema, parquet, JDBC, reports, stored tables.

Stored keyed tables are append-only directories: a merge writes only the new
rows as another set of parquet files (Spark's commit protocol publishes them at
job commit), so a run never rewrites or drops the stored rows and never reads
and overwrites the same files.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.operators.merge import merge_new_rows
from tidyspark.session import materialize
from tidyspark.sources.headers import normalize_headers


RAW_LINE = "__raw_line"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, *,
             header: bool = True, encoding: str = "UTF-8", normalize: bool = True,
             drop: str | None = None, multiline: bool = False,
             corrupt_column: str | None = None) -> DataFrame:
    """CSV with a header. Columns of a declared ``schema`` are bound by their raw
    header names, in whatever order the file has them (a missing one is an
    error); without it every column is a string. With ``normalize`` the header
    names are then normalised. A value that can't be read as its declared type
    becomes NULL, and a row with more or fewer fields than the header keeps those
    that have a column; ``corrupt_column`` (if named) holds the raw text of all such
    rows. ``read_csv_checked`` rejects them instead.
    """
    reader = (spark.read.option("header", header).option("encoding", encoding)
              .option("multiLine", multiline).option("mode", "PERMISSIVE"))
    df = reader.csv(path)
    odd = F.lit(None).cast("string")
    if schema is not None and header and corrupt_column:
        # surplus and missing fields are seen only if every column is read as a text beside the raw line
        texts = T.StructType([*df.schema.fields, T.StructField(RAW_LINE, T.StringType())])
        df = (reader.option("columnNameOfCorruptRecord", RAW_LINE).option("columnPruning", False)
              .schema(texts).csv(path))
        odd = F.col(RAW_LINE)
    if schema is not None and header:
        absent = [f.name for f in schema.fields if f.name not in df.columns]
        if absent:
            raise ValueError(f"the header lacks {absent}")
        raw = [F.col(f"`{f.name}`") for f in schema.fields]
        typed = [c.try_cast(f.dataType) for c, f in zip(raw, schema.fields)]
        out = [t.alias(f.name) for t, f in zip(typed, schema.fields)]
        if corrupt_column:
            bad = reduce(lambda a, b: a | b, [r.isNotNull() & t.isNull() for r, t in zip(raw, typed)])
            out.append(F.coalesce(odd, F.when(bad, F.to_csv(F.struct(*raw)))).alias(corrupt_column))
        df = df.select(*out)
    elif schema is not None:
        df = reader.schema(schema).csv(path)
    if normalize:
        df = normalize_headers(df) if drop is None else normalize_headers(df, drop)
    return df


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None, **options) -> DataFrame | None:
    """Stored table, or None when the path does not exist or holds no file yet
    (a first load that ended before its commit)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as e:
        if re.search("PATH_NOT_FOUND|UNABLE_TO_INFER_SCHEMA", str(e)):
            return None
        raise


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                partition_by=None, **options) -> None:
    w = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def write_report(df: DataFrame, path: str, order_by=None, fmt: str = "csv",
                 single_file: bool = False) -> None:
    """A report as headed CSV. By default the (globally ordered) result is
    written by as many tasks as it has partitions, part files in order; only a
    report known to be small should ask for ``single_file``."""
    out = df if order_by is None else df.orderBy(*order_by)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).format(fmt).save(path)


def merge_into_path(spark: SparkSession, path: str, batch: DataFrame, natural_key, key: str | None,
                    order_by=None, fmt: str = "parquet", schema: T.StructType | None = None,
                    **merge_opts) -> DataFrame:
    """Idempotent update of a stored table: append only the unmatched batch rows.

    First run (no table at ``path``) numbers every batch row from 1. Returns the
    table as stored after the run. ``schema``: the declared one, used when reading.
    """
    existing = read_table(spark, path, fmt, schema)
    _, fresh = merge_new_rows(existing, batch, natural_key, key, order_by,
                              return_new=True, **merge_opts)
    fresh.write.format(fmt).mode("append").save(path)
    return read_table(spark, path, fmt, schema)


# -- JDBC -----------------------------------------------------------------------------

def read_jdbc(spark: SparkSession, url: str, table: str | None = None, *, query: str | None = None,
              properties: dict | None = None, partition_column: str | None = None,
              lower_bound=None, upper_bound=None, num_partitions: int | None = None,
              predicates: list[str] | None = None, fetch_size: int = 10_000) -> DataFrame:
    """JDBC scan spread over ``num_partitions`` range reads of an integer column
    (or one read per predicate) instead of a single-task read."""
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_size))
    if predicates:
        return spark.read.jdbc(url, table or f"({query}) AS q", predicates=predicates,
                               properties=props)
    reader = spark.read.format("jdbc").option("url", url).options(**props)
    # a query can't be read in ranges under its own option, only as a derived table
    reader = (reader.option("query", query) if query and not partition_column
              else reader.option("dbtable", table or f"({query}) AS q"))
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions or 8)))
    return reader.load()


def read_jdbc_partitioned(spark: SparkSession, url: str, table: str, column: str,
                          num_partitions: int = 64, properties: dict | None = None) -> DataFrame:
    """Range-partitioned JDBC read of a table on an integer column; the bounds
    come from one pushed-down MIN/MAX query (a single row)."""
    q = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    lo, hi = read_jdbc(spark, url, query=q, properties=properties).first()
    if lo is None:
        return read_jdbc(spark, url, table, properties=properties)
    return read_jdbc(spark, url, table, properties=properties, partition_column=column,
                     lower_bound=lo, upper_bound=hi, num_partitions=num_partitions)


def _sql_literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def table_exists_jdbc(spark: SparkSession, url: str, table: str, schema: str = "public",
                      properties: dict | None = None) -> bool:
    """Catalog probe with the filter pushed to the database and at most one row read."""
    q = ("SELECT 1 AS hit FROM information_schema.tables "
         f"WHERE table_name = {_sql_literal(table)} AND table_schema = {_sql_literal(schema)}")
    return len(read_jdbc(spark, url, query=q, properties=properties).limit(1).collect()) > 0


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", batch_size: int = 10_000,
               num_partitions: int | None = None) -> None:
    """Write rows over JDBC; merges append only the new rows."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
    df.write.jdbc(url, table, mode=mode, properties=props)


def merge_into_jdbc(spark: SparkSession, url: str, table: str, batch: DataFrame, natural_key,
                    key: str | None, order_by=None, properties: dict | None = None,
                    num_partitions: int = 64, **merge_opts) -> int:
    """Idempotent JDBC update: read the stored rows (range-partitioned on the
    surrogate key), append only the unmatched batch rows."""
    existing = None
    if table_exists_jdbc(spark, url, table, properties=properties):
        existing = (read_jdbc_partitioned(spark, url, table, key, num_partitions, properties)
                    if key else read_jdbc(spark, url, table, properties=properties))
    _, fresh = merge_new_rows(existing, batch, natural_key, key, order_by,
                              return_new=True, **merge_opts)
    fresh = materialize(fresh, "jdbc-new")        # the count must not see the appended rows
    write_jdbc(fresh, url, table, properties)
    return fresh.count()
