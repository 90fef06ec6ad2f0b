"""Incremental loads: the idempotent merge applied to each micro-batch.

``merge_stream`` starts a Structured Streaming query whose ``foreachBatch``
merges the batch into a stored table (append-only, NULL-safe natural key,
keys numbered after the stored maximum). Because the merge is idempotent, a
micro-batch that is replayed after a failure (at-least-once delivery) adds
nothing the second time; the streaming checkpoint tracks source progress.

``merge_stream_into`` merges into a ``StoredTable``, whose pointer keeps the number of
the last micro-batch: one that is replayed is left out after one small read,
without a look at its rows or the stored keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidyspark.sources.store import StoredTable
from tidyspark.sources.tables import merge_into_path


def merge_stream(stream: DataFrame, path: str, natural_key, key: str | None, order_by=None,
                 checkpoint_location: str | None = None, available_now: bool = True,
                 transform=None, **merge_opts) -> StreamingQuery:
    """Merge every micro-batch of ``stream`` into the table at ``path``.

    ``transform`` (DataFrame -> DataFrame) is applied to each batch first,
    e.g. staging and cleaning. ``checkpoint_location`` defaults to
    ``<path>_stream_checkpoint``; it must live in shared storage on a cluster.
    """
    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform is not None else batch
        merge_into_path(batch.sparkSession, path, rows, natural_key, key, order_by,
                        **merge_opts)

    writer = (stream.writeStream.foreachBatch(merge_batch)
              .option("checkpointLocation", checkpoint_location or f"{path.rstrip('/')}_stream_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def merge_stream_into(stream: DataFrame, table: StoredTable, natural_key, key: str | None, order_by=None,
                      sequence: str = "stream", checkpoint_location: str | None = None, available_now: bool = True,
                      transform=None) -> StreamingQuery:
    """Merge every micro-batch into a stored table with versions.

    ``sequence`` names the stream in the table's pointer; a stream with another
    checkpoint needs another name, since its batches are numbered anew.
    """
    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform is not None else batch
        table.merge(rows, natural_key, key, order_by, sequence=sequence, batch_number=batch_id)

    writer = (stream.writeStream.foreachBatch(merge_batch)
              .option("checkpointLocation", checkpoint_location or f"{table.path}_stream_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
