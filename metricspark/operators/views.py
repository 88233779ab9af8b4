"""Wide views of one metric, built from the positions its keys have at the time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.functions.naming import view_key
from metricspark.operators.selectors import key_positions, metric_id, metric_series, slot
from metricspark.schema import NAME_KEY, Catalog


def view_columns(catalog: Catalog, metric_name: str, ids: bool) -> dict[str, int]:
    """Position by column name, in position order, without the metric name."""
    positions = key_positions(catalog, metric_name)
    keys = [k for k in positions if k != NAME_KEY]
    if not keys:
        return {}
    spark = catalog.label_key.sparkSession
    wanted = spark.createDataFrame([(k,) for k in keys], "label string").withColumn("key", view_key(F.col("label")))
    column = "id_column_name" if ids else "value_column_name"
    named = {r["label"]: r[column] for r in wanted.join(catalog.label_key, "key", "left").collect()}
    suffix = "_id" if ids else ""
    # A reserved name whose prefixed key is not registered is named by the same rule.
    return {named[k] or f"label_{k}{suffix}": positions[k] for k in keys}


def metric_view(catalog: Catalog, facts: DataFrame, metric_name: str) -> DataFrame:
    """``time, value, series_id, labels`` and one ``<key>_id`` per key.

    Facts whose series is gone stay, with null labels.
    """
    mine = metric_id(catalog, metric_name)
    rows = facts.filter(F.col("metric_id") == mine)
    series = catalog.series.filter(F.col("metric_id") == mine).select("series_id", "label_ids")
    columns = [slot("label_ids", pos).alias(c) for c, pos in view_columns(catalog, metric_name, True).items()]
    return rows.join(series, "series_id", "left").select(
        "time", "value", "series_id", F.col("label_ids").alias("labels"), *columns
    )


def label_values(series: DataFrame, label_dim: DataFrame, columns: dict[str, int]) -> DataFrame:
    """``series_id`` and the value text at each position; null where not set.

    One join for all keys: the slots are exploded, named, and gathered again by series.
    """
    slots = series.select("series_id", F.posexplode("label_ids").alias("at", "id"))
    slots = slots.filter((F.col("at") > 0) & (F.col("id") != 0))
    named = slots.join(label_dim.select("id", "value"), "id")
    gathered = [F.max(F.when(F.col("at") == pos - 1, F.col("value"))).alias(c) for c, pos in columns.items()]
    return named.groupBy("series_id").agg(*gathered)


def series_view(catalog: Catalog, metric_name: str) -> DataFrame:
    """``series_id, labels`` and one value column per key."""
    series = metric_series(catalog, metric_name).select("series_id", F.col("label_ids"))
    columns = view_columns(catalog, metric_name, False)
    out = series.withColumnRenamed("label_ids", "labels")
    if not columns:
        return out
    return out.join(label_values(series, catalog.label, columns), "series_id", "left")


def label_value(rows: DataFrame, id_column: str, label_dim: DataFrame, alias: str) -> DataFrame:
    """Add the value text of a label id column; null for 0, null and ids not known."""
    names = label_dim.select(F.col("id").alias("_id"), F.col("value").alias(alias))
    return rows.join(names, F.col(id_column) == F.col("_id"), "left").drop("_id")


def group_by_label(
    catalog: Catalog, facts: DataFrame, series: DataFrame, metric_name: str, key: str, value: Column | None = None
) -> DataFrame:
    """Count, sum, least, greatest and mean of the facts of chosen series, by the value of a key.

    The facts shrink to one row per series by map-side aggregation, then meet the series, and
    only the final groups are named. Facts without the key form one group with a null value.
    """
    value = F.col("value") if value is None else value
    per_series = facts.select("metric_id", "series_id", value.alias("v")).groupBy("metric_id", "series_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("v").alias("n_values"), F.sum("v").alias("sum"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )
    grouped = per_series.join(_label_ids(catalog, series, metric_name, key), ["metric_id", "series_id"])
    measures = grouped.groupBy("_label_id").agg(
        F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.min("min").alias("min"), F.max("max").alias("max"),
        (F.sum("sum") / F.nullif(F.sum("n_values"), F.lit(0))).alias("avg"),
    )
    return label_value(measures, "_label_id", catalog.label, key).drop("_label_id")


def aggregate_by_label(
    catalog: Catalog, facts: DataFrame, series: DataFrame, metric_name: str, key: str, *aggregates: Column
) -> DataFrame:
    """The same for any aggregates, which may need every fact of a group."""
    ids = _label_ids(catalog, series, metric_name, key)
    grouped = facts.join(ids, ["metric_id", "series_id"]).groupBy("_label_id").agg(*aggregates)
    return label_value(grouped, "_label_id", catalog.label, key).drop("_label_id")


def _label_ids(catalog: Catalog, series: DataFrame, metric_name: str, key: str) -> DataFrame:
    pos = key_positions(catalog, metric_name).get(key)
    label_id = F.nullif(slot("label_ids", pos), F.lit(0)) if pos else F.lit(None).cast("int")
    return series.select("metric_id", "series_id", label_id.alias("_label_id"))
