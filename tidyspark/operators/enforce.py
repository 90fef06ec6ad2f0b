"""Writing under the rules: rows that break one go to a quarantine instead of the table.

``enforce(tables, specs)`` takes the tables of a model and their ``TableSpec`` and
returns clean tables and one quarantine (table_name, rule, column_name, row as
JSON). Every input row is in exactly one of them, and an ``audit`` of the clean
tables finds nothing:

1. rows with NULL in a NOT NULL column or with too long a text;
2. rows with a reference to no clean parent row (parents are cleaned first);
3. of rows with one primary key all but the smallest.

A row is quarantined for the first rule it breaks, in this order and that of
the columns. Duplicate keys are found by a grouping and only their rows are joined
back, so copies of one key, however many, are one row on the small side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyspark.operators.facts import checked_broadcast
from tidyspark.session import materialize
from tidyspark.specs import TableSpec

BROADCAST_ROWS = 1_000_000
_ID, _RULE, _COLUMN = "__row_id", "__rule", "__column"


def _parents_first(specs: list[TableSpec]) -> list[TableSpec]:
    names, done, out = {s.name for s in specs}, set(), []
    left = list(specs)
    while left:
        ready = [s for s in left if all(r.ref_table in done or r.ref_table not in names or r.ref_table == s.name
                                        for r in s.foreign_keys)]
        if not ready:
            raise ValueError(f"tables refer to each other: {[s.name for s in left]}")
        out += ready
        done |= {s.name for s in ready}
        left = [s for s in left if s.name not in done]
    return out


def _marked(df: DataFrame, condition, rule: str, column: str) -> DataFrame:
    """Rows that no rule has yet and that meet the condition get this one."""
    hit = F.col(_RULE).isNull() & F.coalesce(condition, F.lit(False))
    return df.withColumns({_RULE: F.when(hit, F.lit(rule)).otherwise(F.col(_RULE)),
                           _COLUMN: F.when(hit, F.lit(column)).otherwise(F.col(_COLUMN))})


def _row_rules(df: DataFrame, spec: TableSpec) -> DataFrame:
    for c in spec.not_null:
        df = _marked(df, F.col(c).isNull(), "not_null", c)
    for c, n in (spec.max_length or {}).items():
        df = _marked(df, F.length(c) > n, "max_length", c)
    return df


def _references(df: DataFrame, spec: TableSpec, clean: dict[str, DataFrame], tables: dict[str, DataFrame]) -> DataFrame:
    for ref in spec.foreign_keys:
        if ref.ref_table == spec.name:
            raise ValueError(f"{spec.name} refers to itself")
        parent = clean.get(ref.ref_table, tables.get(ref.ref_table))
        keys = parent.select(*[F.col(r).alias(f"__p{i}") for i, r in enumerate(ref.ref_columns)]).dropna().distinct()
        keys = checked_broadcast(keys.withColumn("__found", F.lit(True)), BROADCAST_ROWS)
        match = reduce(lambda a, b: a & b, [df[c] == keys[f"__p{i}"] for i, c in enumerate(ref.columns)])
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ref.columns])
        df = _marked(df.join(keys, match, "left"), complete & F.col("__found").isNull(), "foreign_key",
                     ",".join(ref.columns)).drop("__found", *[f"__p{i}" for i in range(len(ref.columns))])
    return df


def _primary_key(df: DataFrame, spec: TableSpec) -> DataFrame:
    if not spec.primary_key:
        return df
    key = list(spec.primary_key)
    others = [c for c in df.columns if c not in (*key, _ID, _RULE, _COLUMN)]
    kept = (df.where(F.col(_RULE).isNull()).groupBy(*key)
            .agg(F.count(F.lit(1)).alias("__n"), F.min(F.struct(*others, _ID))[_ID].alias("__kept")).where("__n > 1"))
    kept = checked_broadcast(kept.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(key)], "__kept"),
                             BROADCAST_ROWS)
    match = reduce(lambda a, b: a & b, [df[c].eqNullSafe(kept[f"__k{i}"]) for i, c in enumerate(key)])
    out = _marked(df.join(kept, match, "left"), F.col("__kept").isNotNull() & (F.col(_ID) != F.col("__kept")),
                  "primary_key", ",".join(key))
    return out.drop("__kept", *[f"__k{i}" for i in range(len(key))])


def enforce(tables: dict[str, DataFrame], specs: list[TableSpec]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Clean tables by name, and the quarantine of all. Tables without a spec are returned as they are."""
    clean, parts = dict(tables), []
    done: dict[str, DataFrame] = {}
    for spec in _parents_first(specs):
        columns = tables[spec.name].columns
        # row numbers must not change between the grouping and the join: they are written once
        rows = materialize(tables[spec.name].withColumns({
            _ID: F.monotonically_increasing_id(), _RULE: F.lit(None).cast("string"),
            _COLUMN: F.lit(None).cast("string")}), "enforce-rows")
        judged = materialize(_references(_row_rules(rows, spec), spec, done, tables), "enforce-judged")
        judged = materialize(_primary_key(judged, spec), "enforce-keys")
        done[spec.name] = clean[spec.name] = judged.where(F.col(_RULE).isNull()).select(*columns)
        parts.append(judged.where(F.col(_RULE).isNotNull()).select(
            F.lit(spec.name).alias("table_name"), F.col(_RULE).alias("rule"), F.col(_COLUMN).alias("column_name"),
            F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("row")))
    return clean, reduce(DataFrame.unionByName, parts)
