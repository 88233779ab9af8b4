"""Periodic counters of the ingest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricspark.functions.text import format_bytes

INTERVAL_S = 300
COUNTERS = (
    "scrapes", "scrape_errors", "scrape_timeouts", "scrape_refused", "writes", "write_errors", "write_skips",
    "new_series", "response_bytes", "response_bytes_peak",
)
REPORT = T.StructType([T.StructField(c, T.LongType()) for c in ("interval_start", *COUNTERS)])


def counters() -> list[Column]:
    """The aggregates of one interval, over scrapes of ``outcome, samples, skipped, failed,
    new_series, response_bytes``."""
    of = lambda outcome: F.count_if(F.col("outcome") == outcome)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return [
        of("ok").alias("scrapes"),
        of("failed").alias("scrape_errors"),
        of("timeout").alias("scrape_timeouts"),
        of("refused").alias("scrape_refused"),
        total("samples").alias("writes"),
        total("failed").alias("write_errors"),
        total("skipped").alias("write_skips"),
        total("new_series").alias("new_series"),
        total("response_bytes").alias("response_bytes"),
        F.coalesce(F.max("response_bytes"), F.lit(0)).cast("bigint").alias("response_bytes_peak"),
    ]


def ingest_report(scrapes: DataFrame, interval_s: int = INTERVAL_S) -> DataFrame:
    """One row per interval with scrapes."""
    start = F.col("scrape_ts") - F.pmod(F.col("scrape_ts"), F.lit(interval_s))
    return scrapes.groupBy(start.cast("bigint").alias("interval_start")).agg(*counters())


def added_up(report: DataFrame) -> DataFrame:
    """Parts of a report put together: counters are summed, of peaks the highest stays."""
    peak = "response_bytes_peak"
    sums = [F.sum(c).alias(c) for c in COUNTERS if c != peak]
    return report.groupBy("interval_start").agg(*sums, F.max(peak).alias(peak)).select(REPORT.names)


def readable(report: DataFrame) -> DataFrame:
    """Byte counts as text."""
    columns = ("response_bytes", "response_bytes_peak")
    return report.withColumns({c: format_bytes(F.col(c)) for c in columns})


def target_gauges(targets: DataFrame) -> DataFrame:
    """How many targets there are."""
    return targets.agg(F.count(F.lit(1)).alias("targets"))


def series_gauges(series: DataFrame) -> DataFrame:
    """How many series there are and the bytes of their id arrays."""
    return series.agg(
        F.count(F.lit(1)).alias("series"), (F.coalesce(F.sum(F.size("label_ids")), F.lit(0)) * 4).alias("series_bytes")
    )
