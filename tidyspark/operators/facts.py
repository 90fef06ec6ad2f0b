"""Fact assembly: dimension lookups, role-playing lookups and bridge tables.

Broadcast policy: a dimension is hinted for broadcast only after its row count
is checked against ``broadcast_max_rows`` and its bytes against
``BROADCAST_BYTES`` (one pass over at most n+1 rows).
Without a bound the planner decides: AQE measures the shuffled build side at
run time and switches to a broadcast join only under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise a sort-merge join
is kept, whose skewed partitions AQE splits. A dimension of a few values needs the
bound: AQE doesn't broadcast a side most of whose partitions are empty, and
all rows of one value would meet it in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyspark.functions import parse as P
from tidyspark.functions.parse import split_items, split_note
from tidyspark.operators.keys import dense_key


BROADCAST_BYTES = 64 << 20


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fits_broadcast(dim: DataFrame, max_rows: int) -> bool:
    """At most ``max_rows`` rows and ``BROADCAST_BYTES`` of data."""
    width = sum((F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) + 8
                 for f in dim.schema.fields), F.lit(0))
    rows, size = dim.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= BROADCAST_BYTES


def checked_broadcast(dim: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast-hint ``dim`` only if it has at most ``max_rows`` rows and ``BROADCAST_BYTES`` of data."""
    return F.broadcast(dim) if max_rows is not None and fits_broadcast(dim, max_rows) else dim


def lookup(fact: DataFrame, dim: DataFrame, on, dim_name: str, dim_key: str,
           as_: str | None = None, broadcast_max_rows: int | None = None) -> DataFrame:
    """Left join ``fact`` to ``dim`` on fact value ``on`` = ``dim[dim_name]``; add its key.

    ``on`` is a column name or expression of ``fact`` (e.g. a trimmed text).
    The key is added as ``as_`` (default ``dim_key``); call twice with two
    aliases for a role-playing dimension. Unmatched values get NULL.
    """
    as_ = as_ or dim_key
    probe = "__lk_" + as_
    d = dim.select(F.col(dim_name).alias(probe), F.col(dim_key).alias(as_))
    d = checked_broadcast(d, broadcast_max_rows)
    f = fact.withColumn(probe, _c(on))
    return f.join(d, on=probe, how="left").drop(probe)


TRACKED = 8192                 # values that the summary of frequent ones keeps
MOST_HEAVY = 1000


def heavy_hashes(df: DataFrame, value, share: float = 0.005) -> list[int]:
    """Hashes of the values that hold at least about ``share`` of the rows, at most MOST_HEAVY.

    Every task keeps a summary of TRACKED counters; the summaries are merged, so neither the values nor
    their number reach one task. A value is left out only if it has under
    ``share`` + 7 / TRACKED of the rows.
    """
    found = (df.select(F.xxhash64(_c(value)).alias("h"), _c(value).isNotNull().alias("known")).where("known")
             .agg(F.expr(f"approx_top_k(h, {MOST_HEAVY}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first())
    return [r["item"] for r in found["top"] if r["count"] >= share * found["n"]]


def lookup_spread(fact: DataFrame, dim: DataFrame, on, dim_name: str, dim_key: str, as_: str | None = None,
                  share: float = 0.005) -> DataFrame:
    """``lookup`` for a large dimension and values that hold a large part of the fact.

    Rows with a heavy value stay where they are: the dimension rows of these (at
    most MOST_HEAVY hashes, one row per name) are broadcast. All other rows meet the rest
    of the dimension by a shuffle, in which no value is heavy. Rows without
    a value take part in neither join. The fact is read twice more than by ``lookup``.
    """
    as_ = as_ or dim_key
    probe = "__lk_" + as_
    f = fact.withColumn(probe, _c(on))
    d = dim.select(F.col(dim_name).alias(probe), F.col(dim_key).alias(as_)).where(F.col(probe).isNotNull())
    heavy = F.xxhash64(probe).isin(heavy_hashes(fact, on, share))
    none = f.where(F.col(probe).isNull()).withColumn(as_, F.lit(None).cast(d.schema[as_].dataType))
    stay = f.where(F.col(probe).isNotNull() & heavy).join(F.broadcast(d.where(heavy)), probe, "left")
    rest = f.where(F.col(probe).isNotNull() & ~heavy).join(d.where(~heavy), probe, "left")
    return rest.unionByName(stay).unionByName(none.select(*rest.columns)).drop(probe)


def build_fact(df: DataFrame, lookups: list[dict], columns: list | None = None) -> DataFrame:
    """Chain lookups (each a dict of ``lookup`` keyword arguments) and project."""
    for spec in lookups:
        df = lookup(df, **spec)
    return df if columns is None else df.select(*columns)


def bridge(fact: DataFrame, fact_key: str, value, dim: DataFrame, dim_name: str, dim_key: str,
           note: str = "Obs", key: str | None = None, start: int = 0,
           broadcast_max_rows: int | None = None, sep: str = ",", **dense_opts) -> DataFrame:
    """Many-to-many rows (fact_key, dim_key, note) from a multi-valued cell.

    Items are split outside parentheses, the note is the body of an item's
    parenthetical, the value is looked up in ``dim``. With ``key`` a dense
    surrogate key ordered by (fact_key, dim_key, note) is added. Any ``sep``
    other than "," is taken literally.
    """
    items = fact.select(fact_key, F.posexplode(split_items(value, sep)).alias("__place", "__item"))
    parts = split_note("__item")
    items = (items.select(fact_key, "__place", parts["value"].alias("__value"), parts["note"].alias(note))
             .where(F.col("__value") != ""))
    out = lookup(items, dim, "__value", dim_name, dim_key,
                 broadcast_max_rows=broadcast_max_rows)
    if key is not None:
        # an item's place in its cell tells equal rows of one fact row apart
        out = dense_key(out.select(fact_key, dim_key, note, "__place"), [fact_key, dim_key, note], key, start=start,
                        **{"tie_break": ["__place"], "unique": True, **dense_opts})
        return out.select(key, fact_key, dim_key, note)
    return out.select(fact_key, dim_key, note)


def noted_items(value, sep: str = ",") -> Column:
    """A cell's items as an array of struct(value, note), each pair once, without empty values."""
    if sep == ",":
        return P.noted_items(value)
    pairs = F.transform(split_items(value, sep), lambda x: F.struct(split_note(x)["value"].alias("value"),
                                                                    split_note(x)["note"].alias("note")))
    return F.array_distinct(F.filter(pairs, lambda p: p["value"] != ""))


def bridge_from_items(fact: DataFrame, fact_key: str, items: Column, dim: DataFrame,
                      dim_name: str, dim_key: str, extra: dict | None = None,
                      broadcast_max_rows: int | None = None) -> DataFrame:
    """Bridge rows from an already parsed array column (e.g. weather descriptors)."""
    extra = extra or {}
    ex = fact.select(fact_key, *[v.alias(k) for k, v in extra.items()],
                     F.explode(items).alias("__value"))
    return lookup(ex, dim, "__value", dim_name, dim_key,
                  broadcast_max_rows=broadcast_max_rows).select(fact_key, dim_key, *extra)
