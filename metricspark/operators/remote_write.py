"""Samples as write requests: one time series with one sample each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.functions.labels import label, with_static_labels
from metricspark.schema import NAME_KEY


def time_series(
    samples: DataFrame,
    static: Sequence[tuple[str, str]] | Mapping[str, str] = (),
    target_labels: Column | None = None,
) -> DataFrame:
    """Add ``timeseries``: labels (name, static, own, in that order) and one (value, ms)."""
    labels = F.concat(
        F.array(label(NAME_KEY, F.col("name"))), with_static_labels(F.col("labels"), static, target_labels)
    )
    named = F.transform(labels, lambda p: F.struct(p["key"].alias("name"), p["value"].alias("value")))
    point = F.struct(F.col("value").alias("value"), F.unix_millis("time").alias("timestamp"))
    return samples.withColumn("timeseries", F.struct(named.alias("labels"), F.array(point).alias("samples")))


def write_requests(rows: DataFrame) -> DataFrame:
    """``doc_id, line, timeseries``: a request is the rows of one scrape, in the order of
    their lines. Rows stay single, so that a dump of any size is one request and is never
    gathered; a sender streams them."""
    return rows.select("doc_id", "line", "timeseries")
