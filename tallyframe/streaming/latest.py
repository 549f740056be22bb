"""The newest version of every key, kept up to date by a stream of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.buckets import BucketedTable


def follow_versions(changes: DataFrame, table: BucketedTable, checkpoint: str, compact_every: int = 50, **trigger) -> StreamingQuery:
    """Start a stream that takes every batch of changes into ``table``.

    A batch is written under its number, so a batch that Spark repeats after a failure counts once, and a batch
    in any order of its rows gives the same versions. Every ``compact_every`` batches the log becomes the next base.
    Late versions need no watermark: an older version never replaces a newer one, and no state is held in
    memory. ``trigger`` is passed on (``availableNow=True`` ends when all input is read).
    """
    def take(batch: DataFrame, number: int) -> None:
        table.add_batch(batch, number)
        if len(table.batches()) >= compact_every:
            table.compact()

    return changes.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(**trigger).start()
