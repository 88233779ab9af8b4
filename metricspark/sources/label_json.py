"""Label sets given as JSON objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricspark.functions.labels import labels_from_map
from metricspark.schema import NAME_KEY


def labels_map(text: Column) -> Column:
    """A JSON object as a map of texts; numbers and booleans become their text."""
    return F.from_json(text, "map<string,string>")


def read_labels_json(spark: SparkSession, path: str) -> DataFrame:
    """Files of one JSON label object per line: ``name`` from ``__name__``, and ``labels``."""
    return from_labels_json(spark.read.text(path), "value")


def from_labels_json(rows: DataFrame, column: str) -> DataFrame:
    parsed = labels_map(F.col(column))
    return rows.withColumn("_js", parsed).select(
        "*",
        F.try_element_at("_js", F.lit(NAME_KEY)).alias("name"),
        labels_from_map(F.map_filter("_js", lambda k, _: k != NAME_KEY)).alias("labels"),
    ).drop("_js")
