"""The five report shapes, written as key-level aggregations decorated with names.

Aggregation runs on keys first (map-side partial aggregation collapses hot
keys before the shuffle); dimension names are joined to the small aggregated
result afterwards, so no dimension join sees the fact's row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.operators.facts import TRACKED
from tidyspark.operators.keys import dense_key


def _names(df: DataFrame, key: str, dim: DataFrame | None, dim_key: str | None,
           cols) -> DataFrame:
    if dim is None:
        return df
    d = dim.select(F.col(dim_key).alias(key), *cols)
    return df.join(d, on=key, how="left")


def count_distinct_by(fact: DataFrame, group: str, member: str, count_name: str = "qty",
                      dim: DataFrame | None = None, dim_key: str | None = None,
                      dim_cols=()) -> DataFrame:
    """Q1: distinct (group, member) pairs counted per group, then group names.

    Two-phase (distinct pairs, then count) so a NULL member counts once, like
    GROUP BY over the pairs.
    """
    pairs = fact.select(group, member).distinct()
    counts = pairs.groupBy(group).agg(F.count(F.lit(1)).alias(count_name))
    return _names(counts, group, dim, dim_key, list(dim_cols)).select(
        group, *dim_cols, count_name)


def count_distinct_by_parent(fact: DataFrame, parent: str, member: str,
                             parent_dim: DataFrame, parent_dim_key: str, grand: str,
                             count_name: str = "qty", grand_dim: DataFrame | None = None,
                             grand_dim_key: str | None = None, grand_cols=()) -> DataFrame:
    """Q2: members counted per grand-parent reached through the parent dimension.

    Pairs are reduced to distinct (parent, member) before the parent lookup, so
    the lookup join sees at most one row per pair.
    """
    pairs = fact.select(parent, member).distinct()
    p = parent_dim.select(F.col(parent_dim_key).alias(parent), F.col(grand))
    up = pairs.join(p, on=parent, how="left").select(grand, member).distinct()
    counts = up.groupBy(grand).agg(F.count(F.lit(1)).alias(count_name))
    return _names(counts, grand, grand_dim, grand_dim_key, list(grand_cols)).select(
        grand, *grand_cols, count_name)


def count_bridge(bridge: DataFrame, visit: str, item: str, visit_fact: DataFrame,
                 visit_key: str, group: str, count_name: str = "total",
                 item_dim: DataFrame | None = None, item_dim_key: str | None = None,
                 item_cols=(), group_dim: DataFrame | None = None,
                 group_dim_key: str | None = None, group_cols=(),
                 item_attr: str | None = None) -> DataFrame:
    """Q3: bridge rows counted per (group of the visit, item), then names of both.

    With ``item_attr`` items are counted per that attribute of ``item_dim``
    (e.g. a type) instead of per item key.
    """
    v = visit_fact.select(F.col(visit_key).alias(visit), F.col(group))
    joined = bridge.select(visit, item).join(v, on=visit, how="left")
    if item_attr is not None:
        # the attribute joins counted (group, item) rows, not the bridge
        attrs = item_dim.select(F.col(item_dim_key).alias(item), F.col(item_attr))
        per_item = joined.groupBy(group, item).agg(F.count(F.lit(1)).alias("__n"))
        counts = (per_item.join(attrs, on=item, how="left").groupBy(group, item_attr)
                  .agg(F.sum("__n").alias(count_name)))
        out = _names(counts, group, group_dim, group_dim_key, list(group_cols))
        return out.select(group, *group_cols, item_attr, count_name)
    counts = joined.groupBy(group, item).agg(F.count(F.lit(1)).alias(count_name))
    out = _names(counts, item, item_dim, item_dim_key, list(item_cols))
    out = _names(out, group, group_dim, group_dim_key, list(group_cols))
    return out.select(group, *group_cols, item, *item_cols, count_name)


def rank_by_frequency(bridge: DataFrame, item: str, dim: DataFrame, dim_key: str,
                      name: str, rank_name: str = "Top", label: str | None = None,
                      count_name: str | None = None) -> DataFrame:
    """Q4: items ranked 1..n by occurrence count (desc), ties by name (NULL last).

    The ranking is a distributed dense key over the aggregated items, so even a
    very large vocabulary is not sorted in one task.
    """
    counts = bridge.groupBy(item).agg(F.count(F.lit(1)).alias("__n"))
    named = _names(counts, item, dim, dim_key, [name])
    ranked = dense_key(named, [-F.col("__n"), F.col(name).isNull(), F.col(name)], rank_name,
                       tie_break=[item], unique=True)
    cols = [rank_name, F.col(name).alias(label or name)]
    if count_name:
        cols.append(F.col("__n").alias(count_name))
    return ranked.select(*cols)


def top_by_frequency(bridge: DataFrame, item: str, k: int, rank_name: str = "Top", count_name: str = "n") -> DataFrame:
    """The first ``k`` places of the items by occurrence count (desc), ties by item, NULL last; exactly.

    First every task keeps a summary of TRACKED counters of item hashes, and the merged
    summary names all items that have more than ``7 / TRACKED`` of the rows. Only these are
    counted, so the vocabulary is neither shuffled nor sorted. That settles the
    result if place ``k`` has more rows than an item left out can have; otherwise
    (a flat vocabulary, or fewer items than places) all items are counted, and each task keeps its best ``k``.
    """
    rows = bridge.select(F.col(item))
    seen = rows.agg(F.expr(f"approx_top_k(xxhash64(`{item}`), {TRACKED // 4}, {TRACKED})").alias("top"),
                    F.count(F.lit(1)).alias("n")).first()
    hashes = [r["item"] for r in seen["top"]]            # at most TRACKED / 4 numbers
    # the most rows that an item left out can have
    unseen = max([7 * seen["n"] / TRACKED] + [r["count"] for r in seen["top"][TRACKED // 4 - 1:]])

    def best(of: DataFrame) -> DataFrame:
        counts = of.groupBy(item).agg(F.count(F.lit(1)).alias(count_name))
        return counts.orderBy(F.desc(count_name), F.col(item).asc_nulls_last()).limit(k)

    top = best(rows.where(F.xxhash64(item).isin(hashes)))
    places = top.collect() if len(hashes) >= k else []           # k rows
    if len(places) < k or places[-1][count_name] <= unseen:
        places = best(rows).collect()
    schema = T.StructType([T.StructField(rank_name, T.LongType()), *top.schema.fields])
    return bridge.sparkSession.createDataFrame([(i + 1, *r) for i, r in enumerate(places)], schema)


def count_by_attribute(fact: DataFrame, group: str, attr: str, count_name: str = "total",
                       group_dim: DataFrame | None = None, group_dim_key: str | None = None,
                       group_cols=(), attr_dim: DataFrame | None = None,
                       attr_dim_key: str | None = None, attr_cols=(),
                       keep_attr_key: bool = True) -> DataFrame:
    """Q5: rows counted per (group, attribute key), then both names."""
    counts = fact.groupBy(group, attr).agg(F.count(F.lit(1)).alias(count_name))
    out = _names(counts, attr, attr_dim, attr_dim_key, list(attr_cols))
    out = _names(out, group, group_dim, group_dim_key, list(group_cols))
    keys = [attr] if keep_attr_key else []
    return out.select(group, *group_cols, *keys, *attr_cols, count_name)
