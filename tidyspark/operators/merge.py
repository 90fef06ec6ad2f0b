"""Idempotent merge of a batch into a keyed table.

``merge_new_rows`` keeps every stored row and its key, and appends the batch
rows whose natural key is not stored yet, numbered ``max(key)+1 ...`` in the
order of ``order_by``. Running it again with the same batch changes nothing.

Matching is NULL-safe (``<=>``): a batch row with a NULL in its natural key
matches a stored row with the same NULL, so repeated runs never insert it
twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyspark.operators.keys import dense_key
from tidyspark.session import materialize as _materialize


def _dedupe_on(df: DataFrame, natural_key: list[str]) -> DataFrame:
    """One row per natural key; among differing rows the smallest one wins.

    Implemented as an aggregation so map-side partial aggregation collapses a
    hot key before the shuffle; the survivor does not depend on row order.
    """
    others = [c for c in df.columns if c not in natural_key]
    df = df.distinct()              # exact copies go by hash aggregation first
    if not others:
        return df
    # min over a struct = lexicographically smallest full row, deterministic
    picked = df.groupBy(*natural_key).agg(F.min(F.struct(*others)).alias("__row"))
    return picked.select(*natural_key, *[F.col("__row")[c].alias(c) for c in others]).select(
        *df.columns)


BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def _fits_broadcast(keys: DataFrame) -> bool:
    """At most BROADCAST_ROWS keys and BROADCAST_BYTES of them, read from a written batch."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16
                 for c in keys.columns), F.lit(0))
    rows, size = keys.agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def _matches(left: DataFrame, right: str, natural_key: list[str]):
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(F.col(f"{right}.{c}")) for c in natural_key])


def distinct_batch(batch: DataFrame, natural_key: list[str]) -> DataFrame:
    """The batch with one row per natural key, written once."""
    return _materialize(_dedupe_on(batch, natural_key), "merge-batch")


def unmatched(existing: DataFrame, batch: DataFrame, natural_key: list[str]) -> DataFrame:
    """Rows of a written batch whose natural key ``existing`` does not have.

    The cost follows the batch: the stored keys are first reduced to those that
    the batch has. For a batch of checked size its keys are broadcast, and the
    stored table is only scanned, never shuffled; for a larger one both sides
    are shuffled on the key.
    """
    stored = existing.select(*natural_key)
    keys = batch.select(*natural_key)
    if _fits_broadcast(keys):
        known = stored.join(F.broadcast(keys.alias("__b")), _matches(stored, "__b", natural_key),
                            "left_semi").distinct()
        stored = F.broadcast(known)      # no more rows than the batch
    return batch.join(stored.alias("__s"), _matches(batch, "__s", natural_key), "left_anti")


def new_rows(existing: DataFrame | None, batch: DataFrame, natural_key: list[str]) -> DataFrame:
    """Batch rows (deduplicated on the natural key) that are not stored yet."""
    if existing is None:
        return _dedupe_on(batch, natural_key)
    return unmatched(existing, distinct_batch(batch, natural_key), natural_key)


def max_key(existing: DataFrame | None, key: str) -> int:
    """COALESCE(MAX(key), 0): one scalar reaches the driver."""
    if existing is None:
        return 0
    v = existing.agg(F.max(key)).first()[0]
    return int(v) if v is not None else 0


def merge_new_rows(existing: DataFrame | None, batch: DataFrame, natural_key, key: str | None,
                   order_by=None, *, return_new: bool = False, **dense_opts):
    """Stored rows UNION ALL unmatched batch rows numbered after the current maximum.

    ``existing`` may be None (first load). ``batch`` carries the table's columns
    except ``key``. ``order_by`` (default: the natural key) orders the new keys.
    ``key=None`` keeps the batch's own identifiers (a natural key): unmatched
    rows are appended as they are.
    """
    if isinstance(natural_key, str):
        natural_key = [natural_key]
    order_by = list(natural_key if order_by is None else
                    ([order_by] if isinstance(order_by, str) else order_by))
    cols = [c for c in (existing.columns if existing is not None else batch.columns) if c != key]
    fresh = new_rows(existing, batch.select(*cols), natural_key)
    if key is None:
        merged = fresh if existing is None else existing.unionByName(fresh)
        return (merged, fresh) if return_new else merged
    start = max_key(existing, key)
    # one row per natural key is left, so the rows differ
    numbered = dense_key(fresh, order_by, key, start=start, unique=True, **dense_opts)
    out_cols = existing.columns if existing is not None else [key, *cols]
    numbered = numbered.select(*out_cols)
    merged = numbered if existing is None else existing.unionByName(numbered)
    return (merged, numbered) if return_new else merged
