"""Constraint audit: what a database would have enforced, reported as counts.

``audit(tables, specs)`` returns one DataFrame ``(table_name, check_name,
column_name, violations)`` with a row per declared rule, zero included:

* ``primary_key_duplicates`` - rows whose key value occurs more than once;
* ``not_null`` - NULLs in a NOT NULL column;
* ``foreign_key_orphans`` - non-NULL references without a parent row;
* ``max_length`` - texts longer than the declared length (NULL and length
  rules of a table share one aggregation pass).

Scale: references are pre-aggregated to (value, count) before the anti join,
so a value used by a third of the rows is one row in the join; duplicate keys
are a grouped count with map-side combine.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyspark.specs import TableSpec

def _row(df: DataFrame, table: str, check: str, column: str, n_col) -> DataFrame:
    return df.select(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                     F.lit(column).alias("column_name"),
                     F.coalesce(n_col, F.lit(0)).cast("long").alias("violations"))


def pk_duplicates(df: DataFrame, table: str, key) -> DataFrame:
    key = list(key)
    dup = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    return _row(dup.agg(F.sum("__n").alias("__v")), table, "primary_key_duplicates",
                ",".join(key), F.col("__v"))


def column_checks(df: DataFrame, table: str, not_null=(), max_length=None) -> list[DataFrame]:
    """NOT NULL and text-length rules of one table in a single aggregation pass."""
    rules = [("not_null", c, F.col(c).isNull()) for c in not_null]
    rules += [("max_length", c, F.length(c) > n) for c, n in (max_length or {}).items()]
    if not rules:
        return []
    agg = df.agg(*[F.sum(cond.cast("long")).alias(f"__v{i}")
                   for i, (_, _, cond) in enumerate(rules)])
    # the single aggregated row becomes one row per rule
    pairs = ", ".join(f"'{check}', '{_sql_text(col)}', __v{i}"
                      for i, (check, col, _) in enumerate(rules))
    long = agg.select(F.expr(f"stack({len(rules)}, {pairs}) AS (__k, __c, __v)"))
    return [long.select(F.lit(table).alias("table_name"), F.col("__k").alias("check_name"),
                        F.col("__c").alias("column_name"),
                        F.coalesce(F.col("__v"), F.lit(0)).cast("long").alias("violations"))]


def _sql_text(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def fk_orphans(child: DataFrame, table: str, cols, parent: DataFrame, ref_cols) -> DataFrame:
    cols, ref_cols = list(cols), list(ref_cols)
    refs = (child.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
            .groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")))
    keys = parent.select(*[F.col(r).alias(f"__p{i}") for i, r in enumerate(ref_cols)]).distinct()
    cond = reduce(lambda a, b: a & b, [refs[c] == keys[f"__p{i}"] for i, c in enumerate(cols)])
    orphans = refs.join(keys, cond, "left_anti")
    return _row(orphans.agg(F.sum("__n").alias("__v")), table, "foreign_key_orphans",
                ",".join(cols), F.col("__v"))


def audit(tables: dict[str, DataFrame], specs: list[TableSpec]) -> DataFrame:
    parts: list[DataFrame] = []
    for spec in specs:
        df = tables[spec.name]
        if spec.primary_key:
            parts.append(pk_duplicates(df, spec.name, spec.primary_key))
        parts += column_checks(df, spec.name, spec.not_null, spec.max_length)
        for ref in spec.foreign_keys:
            parts.append(fk_orphans(df, spec.name, ref.columns, tables[ref.ref_table],
                                    ref.ref_columns))
    return reduce(DataFrame.unionByName, parts)
