"""Distinct counts per group that follow a table by its new rows instead of being counted again.

``MaintainedCounts`` answers ``SELECT group, count(DISTINCT member)`` (a NULL
counts once, as in ``reports.count_distinct_by``) for rows that come in batches.
Its state is the set of (group, member) pairs, a stored table in buckets, so a batch
is compared with its own buckets only, and one row (group, new pairs) for every
group that a batch touched. The report adds these rows up by group.

An update publishes the pairs first. The counts remember which version of the pairs they
have seen; an update that ended between the two steps is made up for by the next, which
counts the folders added since.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyspark.sources.store import StoredTable

SEQUENCE = "pairs"


class MaintainedCounts:
    def __init__(self, spark: SparkSession, path: str, group: str, member: str, buckets: int = 64):
        self.group, self.member = group, member
        self.pairs = StoredTable(spark, f"{path.rstrip('/')}/pairs", buckets)
        self.counts = StoredTable(spark, f"{path.rstrip('/')}/counts")

    def update(self, batch: DataFrame) -> int:
        """Take in a batch's rows; the number of pairs that are new."""
        n = self.pairs.merge(batch.select(self.group, self.member), [self.group, self.member])
        self.catch_up()
        return n

    def catch_up(self) -> None:
        """Count the pairs that were published and not counted yet."""
        seen = self.counts.version()
        since = seen.batches.get(SEQUENCE, 0) if seen else 0
        new = self.pairs.version()
        if new is None or new.number <= since:
            return
        rows = self.pairs.added(since)
        if rows is not None:
            per_group = rows.groupBy(self.group).agg(F.count(F.lit(1)).alias("qty"))
            self.counts.append(per_group, SEQUENCE, new.number)

    def report(self) -> DataFrame | None:
        """(group, qty) over all batches so far."""
        deltas = self.counts.read()
        return None if deltas is None else deltas.groupBy(self.group).agg(F.sum("qty").alias("qty"))
