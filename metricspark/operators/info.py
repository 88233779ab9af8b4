"""Overviews of metrics and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.operators.ids import assign_ids
from metricspark.operators.settings import effective_settings
from metricspark.schema import Catalog


def metric_info(catalog: Catalog, summary: DataFrame) -> DataFrame:
    """One row per metric: settings in force, sorted label keys, and what is stored.

    Reads the summary of series and chunks, never the facts; it shrinks to a row per series
    before anything else.
    """
    per_series = summary.groupBy("metric_id", "series_id").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    samples = per_series.groupBy("metric_id").agg(
        F.sum("n").alias("n_samples"),
        F.count(F.lit(1)).alias("n_series"),
        F.min("first").alias("first_time"),
        F.max("last").alias("last_time"),
    )
    chunks = (
        summary.select("metric_id", "chunk_start").distinct().groupBy("metric_id").agg(F.count(F.lit(1)).alias("n_chunks"))
    )
    keys = catalog.label_key_position.groupBy("metric_name").agg(
        F.array_sort(F.collect_list("key")).alias("label_keys")
    )
    none = F.array().cast("array<string>")
    return (
        catalog.metric.select("metric_id", "metric_name", "table_name")
        .join(effective_settings(catalog).drop("metric_name"), "metric_id")
        .join(keys, "metric_name", "left")
        .join(samples, "metric_id", "left")
        .join(chunks, "metric_id", "left")
        .select(
            "metric_id", "metric_name", "table_name", "retention_s", "chunk_interval_s",
            F.coalesce("label_keys", none).alias("label_keys"),
            F.coalesce("n_samples", F.lit(0)).alias("n_samples"),
            F.coalesce("n_series", F.lit(0)).alias("n_series"),
            "first_time", "last_time",
            F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"),
        )
    )


def label_info(catalog: Catalog) -> DataFrame:
    """One row per value of each key, with the key's view columns and the value's rank from 1.

    A key without values has one row with neither. The rank comes from a range sort over all
    keys, so no key's values are gathered.
    """
    ranked = assign_ids(catalog.label.select("key", "value"), ["key", "value"], "n", "bigint")
    first = ranked.groupBy("key").agg(F.min("n").alias("first"))
    values = ranked.join(first, "key").select("key", "value", (F.col("n") - F.col("first") + 1).alias("rank"))
    return catalog.label_key.join(values, "key", "left").select("key", "value_column_name", "id_column_name", "value", "rank")
