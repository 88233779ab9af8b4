"""Continuous ingest of scrape dumps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from metricspark.plans.scrapes import ingest_dumps
from metricspark.plans.snapshots import stream_id
from metricspark.plans.store import MetricStore

SCRAPE_INTERVAL = "15 seconds"


def stream_ingest(
    docs: DataFrame,
    store: MetricStore,
    checkpoint: str,
    static: Sequence[tuple[str, str]] | Mapping[str, str] = (),
    targets: DataFrame | Callable[[], DataFrame] | None = None,
    sink: str = "table",
    timestamp_unit: str = "ms",
    interval: str | None = SCRAPE_INTERVAL,
) -> StreamingQuery:
    """Write a stream of dumps (see ``read_exposition``) into a store, batch by batch.

    Every step of a batch overwrites what an earlier attempt at it wrote, so a batch run
    again after a failure changes nothing. The stream has a name of its own as a writer, kept in
    the checkpoint, so batches by hand, other streams and a stream begun anew under the same
    path do not meet its batch ids. ``targets`` may be a
    function, such as ``target_set(spark, folder).latest``, which each batch calls for the
    targets of the moment. Without an interval the query takes what there is and stops.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        now = targets() if callable(targets) else targets
        ingest_dumps(store, batch, batch_id, static, now, sink, timestamp_unit, writer=stream_id(store.spark, checkpoint))

    writer = docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
