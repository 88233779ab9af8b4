"""Get-or-create steps for the dimensions, each as one set-based job.

Every step keeps the rows a dimension already has, adds the incoming keys it lacks, and
returns the rows it adds, so that a replay of the same input adds nothing. Ids are dense
and follow the sort order of the keys, which makes them repeatable.

A step needs only those rows of the dimension that hold incoming keys; ``after`` is then the
highest id the dimension has given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricspark.functions.naming import id_column_name, unique_name, value_column_name
from metricspark.operators.ids import assign_ids
from metricspark.schema import NAME_KEY


def missing(incoming: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    return incoming.select(*keys).distinct().join(dim.select(*keys), keys, "left_anti")


def new_labels(label: DataFrame, incoming: DataFrame, after: int | None = None) -> DataFrame:
    """``id, key, value`` for the (key, value) pairs not in the dictionary yet."""
    fresh = missing(incoming, label, ["key", "value"])
    return assign_ids(fresh, ["key", "value"], "id", after=label if after is None else after)


def new_metrics(metric: DataFrame, incoming: DataFrame, after: int | None = None) -> DataFrame:
    """Metrics for the names not known yet, on default settings."""
    fresh = missing(incoming, metric, ["metric_name"])
    ids = assign_ids(fresh, ["metric_name"], "metric_id", after=metric if after is None else after)
    return ids.select(
        "metric_id",
        "metric_name",
        unique_name(F.col("metric_name"), F.col("metric_id").cast("string")).alias("table_name"),
        F.lit(True).alias("default_chunk_interval"),
        F.lit(None).cast("bigint").alias("chunk_interval_s"),
        F.lit(None).cast("bigint").alias("retention_s"),
    )


def get_or_create_metrics(metric: DataFrame, incoming: DataFrame) -> DataFrame:
    """Id and table of every incoming name, with ``possibly_new`` for those just made."""
    names = incoming.select("metric_name").distinct()
    known = metric.join(names, "metric_name", "left_semi")
    columns = ["metric_id", "metric_name", "table_name"]
    return known.select(*columns, F.lit(False).alias("possibly_new")).unionByName(
        new_metrics(metric, names).select(*columns, F.lit(True).alias("possibly_new"))
    )


def new_label_keys(label_key: DataFrame, incoming: DataFrame, after: int | None = None) -> DataFrame:
    """Keys not known yet, with the view columns named after them."""
    fresh = missing(incoming, label_key, ["key"])
    ids = assign_ids(fresh, ["key"], "id", after=label_key if after is None else after)
    return ids.select(
        "id",
        "key",
        value_column_name(F.col("key"), F.col("id")).alias("value_column_name"),
        id_column_name(F.col("key"), F.col("id")).alias("id_column_name"),
    )


def new_label_positions(positions: DataFrame, incoming: DataFrame) -> DataFrame:
    """Array positions for new keys of a metric, after those it has.

    The metric name is always at 1 and other keys start at 2; positions are never moved or
    used again. The window runs over the distinct new keys of one metric.
    """
    fresh = missing(incoming, positions, ["metric_name", "key"])
    taken = positions.groupBy("metric_name").agg(F.max("pos").alias("taken"))
    by_metric = Window.partitionBy("metric_name").orderBy("key")
    others = (
        fresh.filter(F.col("key") != NAME_KEY)
        .withColumn("n", F.row_number().over(by_metric))
        .join(taken, "metric_name", "left")
        .select("metric_name", "key", (F.coalesce("taken", F.lit(1)) + F.col("n")).cast("int").alias("pos"))
    )
    names = fresh.filter(F.col("key") == NAME_KEY).select("metric_name", "key", F.lit(1).alias("pos"))
    return names.unionByName(others)


def new_series(series: DataFrame, encoded: DataFrame, after: int | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Series for the (metric, label ids) combinations not known yet. With ``carry``, further columns:
    ``lists``, the rows of ``encoded`` a series has, and the columns named, which are right if it has one."""
    keys = ["metric_id", "label_ids"]
    fresh = missing(encoded, series, keys)
    if carry:
        rows = encoded.groupBy(*keys).agg(F.count(F.lit(1)).alias("lists"), *(F.max(c).alias(c) for c in carry))
        fresh = rows.join(series.select(*keys), keys, "left_anti")
    return assign_ids(fresh, ["metric_id", "label_ids"], "series_id", "bigint", after=series if after is None else after)


# -- look-ups ------------------------------------------------------------------------------


def metric_by_name(metric: DataFrame, name: str) -> DataFrame:
    """Id and table of a metric; no row if it does not exist."""
    return metric.filter(F.col("metric_name") == name).select("metric_id", "table_name")


def label_key_position(positions: DataFrame, metric_name: str, key: str) -> DataFrame:
    """Array position of a key of a metric; no row if the metric has no such key."""
    return positions.filter((F.col("metric_name") == metric_name) & (F.col("key") == key)).select("pos")
