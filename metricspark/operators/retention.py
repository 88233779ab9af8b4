"""Dropping old chunks, with the series and labels nothing uses any more.

All metrics are handled by one job. It works on two small tables that every write extends, so no
fact is read: a summary with a row per series and chunk, and a count of the series that use each
label.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.operators.settings import effective_settings
from metricspark.schema import Catalog
from metricspark.session import durable

CHUNK = ["metric_id", "chunk_start", "chunk_end"]


@dataclass(frozen=True)
class Retention:
    """What is left, and what goes. ``use_change`` is what the label counts change by."""

    catalog: Catalog
    cutoffs: DataFrame
    dropped_chunks: DataFrame
    dropped_series: DataFrame
    dropped_labels: DataFrame
    use_change: DataFrame

    def remaining(self, rows: DataFrame) -> DataFrame:
        """Facts or summary rows of the chunks that stay."""
        kept = rows.join(self.cutoffs, "metric_id", "left")
        return kept.filter(F.col("cutoff_s").isNull() | (F.col("chunk_end") > F.col("cutoff_s"))).select(*rows.columns)


def chunk_summary(facts: DataFrame) -> DataFrame:
    """``metric_id, chunk_start, chunk_end, series_id, n, first, last``."""
    return facts.groupBy(*CHUNK, "series_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("time").alias("first"), F.max("time").alias("last")
    )


def label_use(series: DataFrame) -> DataFrame:
    """``metric_id, id, n``: how many series of a metric use a label. Changes add up."""
    return series.select("metric_id", F.explode("label_ids").alias("id")).groupBy("metric_id", "id").agg(F.count(F.lit(1)).alias("n"))


def chunks(summary: DataFrame) -> DataFrame:
    return summary.select(*CHUNK).distinct()


def expired_metrics(catalog: Catalog, summary: DataFrame, now_s: int) -> DataFrame:
    """Metrics with a chunk that lies wholly before ``now`` less the retention period."""
    settings = effective_settings(catalog).select("metric_id", (F.lit(now_s) - F.col("retention_s")).alias("limit_s"))
    old = chunks(summary).join(settings, "metric_id").filter("chunk_end <= limit_s")
    return catalog.metric.join(old, "metric_id", "left_semi")


def cutoffs(chunk_list: DataFrame, limits: DataFrame) -> DataFrame:
    """Per metric the greatest chunk end at or before its limit (``metric_id, limit_s``).

    A metric without such a chunk has no row: nothing of it is dropped.
    """
    return (
        chunk_list.join(limits, "metric_id")
        .filter("chunk_end <= limit_s")
        .groupBy("metric_id")
        .agg(F.max("chunk_end").alias("cutoff_s"))
    )


def drop_old(catalog: Catalog, summary: DataFrame, use: DataFrame, limits: DataFrame, scope: str = "all") -> Retention:
    """Drop the chunks before each metric's limit, the series that had facts there and have
    none left, and the labels only such series used.

    ``use`` counts the series before (:func:`label_use`, or its changes); only labels of dropped
    series are looked up there. A series that never had facts is kept. ``scope="all"`` keeps a
    label any series still uses; ``scope="metric"`` looks only at the series of the metric that
    lost one.
    """
    if scope not in ("all", "metric"):
        raise ValueError(f"unknown scope {scope!r}")
    cuts = durable(cutoffs(chunks(summary), limits), "cutoffs")
    dropped_chunks = chunks(summary).join(cuts, "metric_id").filter("chunk_end <= cutoff_s").select(*CHUNK)
    gone = (
        summary.groupBy("metric_id", "series_id")
        .agg(F.max("chunk_end").alias("last_end"))
        .join(cuts, "metric_id")
        .filter("last_end <= cutoff_s")
        .select("metric_id", "series_id")
    )
    series_keys = ["metric_id", "series_id"]
    dropped = durable(catalog.series.join(gone, series_keys, "left_semi"), "dropped-series")
    change = durable(label_use(dropped).withColumn("n", -F.col("n")), "use-change")
    label_keys = ["metric_id", "id"] if scope == "metric" else ["id"]
    touched = use.join(change.select(*label_keys).distinct(), label_keys, "left_semi")
    left = touched.select(*label_keys, "n").unionByName(change.select(*label_keys, "n")).groupBy(*label_keys).agg(F.sum("n").alias("n"))
    unused = left.filter("n <= 0").select("id").distinct()
    return Retention(
        catalog=catalog.with_(
            series=catalog.series.join(dropped, series_keys, "left_anti"), label=catalog.label.join(unused, "id", "left_anti")
        ),
        cutoffs=cuts,
        dropped_chunks=dropped_chunks,
        dropped_series=dropped,
        dropped_labels=catalog.label.join(unused, "id", "left_semi"),
        use_change=change,
    )


def metric_limit(catalog: Catalog, metric_name: str, older_than_s: int) -> DataFrame:
    """A given time as the limit of one metric."""
    return catalog.metric.filter(F.col("metric_name") == metric_name).select(
        "metric_id", F.lit(older_than_s).cast("bigint").alias("limit_s")
    )


def period_limits(catalog: Catalog, now_s: int) -> DataFrame:
    """The limit of every metric by its retention period, as of ``now``."""
    return effective_settings(catalog).select("metric_id", (F.lit(now_s) - F.col("retention_s")).alias("limit_s"))


def drop_metric_chunks(
    catalog: Catalog, summary: DataFrame, use: DataFrame, metric_name: str, older_than_s: int, scope: str = "all"
) -> Retention:
    """Drop what one metric has before a given time."""
    return drop_old(catalog, summary, use, metric_limit(catalog, metric_name, older_than_s), scope)


def drop_chunks(catalog: Catalog, summary: DataFrame, use: DataFrame, now_s: int, scope: str = "all") -> Retention:
    """Apply every metric's retention period as of ``now``."""
    return drop_old(catalog, summary, use, period_limits(catalog, now_s), scope)
