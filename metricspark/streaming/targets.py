"""The set of targets, kept from a stream of pod events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from metricspark.operators.targets import fold_targets
from metricspark.plans.snapshots import Snapshots, stream_id
from metricspark.schema import TARGET


def target_set(spark, folder: str) -> Snapshots:
    return Snapshots(spark, folder, TARGET)


def stream_targets(
    events: DataFrame,
    folder: str,
    checkpoint: str,
    own: str,
    enabled: Sequence[str] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Fold each batch of events into the targets the batch before left, of this stream or, with
    a new checkpoint, of the stream before.

    Readers take ``target_set(spark, folder).latest()``.
    """
    state = target_set(events.sparkSession, folder)

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(events.sparkSession, checkpoint)
        state.write(fold_targets(batch, own, enabled, state.latest((stream, batch_id))), stream, batch_id)

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
