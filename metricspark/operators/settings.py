"""Chunk interval and retention: defaults, overrides per metric, chunk bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricspark.operators.dictionary import new_metrics
from metricspark.schema import METRIC, Catalog, local_rows

CHUNK_INTERVAL = "chunk_interval"
RETENTION_PERIOD = "retention_period"
KINDS = (CHUNK_INTERVAL, RETENTION_PERIOD)


def defaults(settings: DataFrame) -> dict[str, int]:
    """The default of each kind; the table has one row per kind."""
    return {r["key"]: r["value_s"] for r in settings.filter(F.col("key").isin(*KINDS)).collect()}


def effective_settings(catalog: Catalog) -> DataFrame:
    """Chunk interval and retention of every metric: its own, else the default."""
    default = defaults(catalog.settings)
    own_interval = F.when(~F.col("default_chunk_interval"), F.col("chunk_interval_s"))
    return catalog.metric.select(
        "metric_id",
        "metric_name",
        F.coalesce(own_interval, F.lit(default[CHUNK_INTERVAL]).cast("bigint")).alias("chunk_interval_s"),
        F.coalesce("retention_s", F.lit(default[RETENTION_PERIOD]).cast("bigint")).alias("retention_s"),
    )


def effective_settings_of(catalog: Catalog, names: DataFrame) -> DataFrame:
    """The same for given ``metric_name``s; a metric not known has the defaults."""
    default = defaults(catalog.settings)
    known = effective_settings(catalog).drop("metric_id")
    return names.join(known, "metric_name", "left").select(
        "metric_name",
        F.coalesce("chunk_interval_s", F.lit(default[CHUNK_INTERVAL]).cast("bigint")).alias("chunk_interval_s"),
        F.coalesce("retention_s", F.lit(default[RETENTION_PERIOD]).cast("bigint")).alias("retention_s"),
    )


def _check(kind: str) -> None:
    if kind not in KINDS:
        raise ValueError(f"unknown setting {kind!r}")


def set_default(catalog: Catalog, kind: str, seconds: int) -> Catalog:
    """Change a default. Metrics without an override follow at once."""
    _check(kind)
    kept = catalog.settings.filter(F.col("key") != kind)
    spark = kept.sparkSession
    return catalog.with_(settings=kept.unionByName(local_rows(spark, [(kind, seconds)], kept.schema)))


def set_metric(catalog: Catalog, kind: str, metric_name: str, seconds: int) -> Catalog:
    """Override a setting for a metric, which is made if it does not exist."""
    _check(kind)
    spark = catalog.metric.sparkSession
    wanted = local_rows(spark, [(metric_name,)], T.StructType([METRIC["metric_name"]]))
    metric = catalog.metric.unionByName(new_metrics(catalog.metric, wanted))
    return catalog.with_(metric=_override(metric, kind, metric_name, seconds))


def reset_metric(catalog: Catalog, kind: str, metric_name: str) -> Catalog:
    """Drop the override of a metric."""
    _check(kind)
    return catalog.with_(metric=_override(catalog.metric, kind, metric_name, None))


def _override(metric: DataFrame, kind: str, metric_name: str, seconds: int | None) -> DataFrame:
    this = F.col("metric_name") == metric_name
    value = F.lit(seconds).cast("bigint")
    if kind == RETENTION_PERIOD:
        return metric.withColumn("retention_s", F.when(this, value).otherwise(F.col("retention_s")))
    return metric.withColumns(
        {
            "chunk_interval_s": F.when(this, value).otherwise(F.col("chunk_interval_s")),
            "default_chunk_interval": F.when(this, F.lit(seconds is None)).otherwise(F.col("default_chunk_interval")),
        }
    )


def chunk_bounds(time: Column, interval_s: Column) -> tuple[Column, Column]:
    """Start and end (exclusive) of the chunk of an instant, in epoch seconds."""
    second = F.unix_seconds(time)
    start = second - F.pmod(second, interval_s)
    return start, start + interval_s


def in_time_range(facts: DataFrame, start_s: int | None = None, end_s: int | None = None) -> DataFrame:
    """Facts with ``start_s <= time < end_s``.

    The bounds are put on the chunk columns as well, which a predicate on the time alone
    would not prune by. Chunks keep the interval they were written with, so both of their
    ends are tested.
    """
    if start_s is not None:
        facts = facts.filter((F.col("chunk_end") > start_s) & (F.col("time") >= F.timestamp_seconds(F.lit(start_s))))
    if end_s is not None:
        facts = facts.filter((F.col("chunk_start") < end_s) & (F.col("time") < F.timestamp_seconds(F.lit(end_s))))
    return facts
