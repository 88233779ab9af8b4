"""The ingest report as a stream: counters of each batch, added up when they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from metricspark.operators.report import INTERVAL_S, REPORT, added_up, ingest_report
from metricspark.plans.snapshots import read_or_empty, stream_id


def stream_report(
    scrapes: DataFrame, folder: str, checkpoint: str, interval_s: int = INTERVAL_S, interval: str | None = None
) -> StreamingQuery:
    """Write the counters of each batch, a row per interval it touches, to ``folder``.

    There is no watermark and no state: scrapes count however late they come. A batch run
    again overwrites its own rows; a stream with a new checkpoint adds to those of the one before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(scrapes.sparkSession, checkpoint)
        ingest_report(batch, interval_s).write.mode("overwrite").parquet(f"{folder}/stream={stream}/batch_id={batch_id}")

    writer = scrapes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def read_report(spark: SparkSession, folder: str) -> DataFrame:
    """One row per interval, over all batches of all streams so far; none before the first."""
    return added_up(read_or_empty(spark, folder, REPORT))
