"""Bookmarks of targets, carried from batch to batch.

The order of scrapes within a batch comes from the batch operator, which spreads a target
with most of the scrapes over many tasks; a state function per target would take all of its
rows at once. Only one row per target is carried on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from metricspark.operators.age import bookmarks, last_scrapes
from metricspark.plans.snapshots import Snapshots, stream_id
from metricspark.schema import BOOKMARK


def stream_bookmarks(scrapes: DataFrame, folder: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Write ``min_ts``, the oldest accepted time, of each scrape of ``doc_id, target,
    scrape_ts`` to ``<folder>/scrapes``, and the bookmarks to ``<folder>/bookmarks``. A stream
    with a new checkpoint adds to the scrapes and goes on from the bookmarks."""
    state = Snapshots(scrapes.sparkSession, f"{folder}/bookmarks", BOOKMARK)

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(scrapes.sparkSession, checkpoint)
        before = state.latest((stream, batch_id))
        bookmarks(batch, before).write.mode("overwrite").parquet(f"{folder}/scrapes/stream={stream}/batch_id={batch_id}")
        state.write(last_scrapes(batch, before), stream, batch_id)

    narrow = scrapes.select("doc_id", "target", "scrape_ts")
    writer = narrow.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
