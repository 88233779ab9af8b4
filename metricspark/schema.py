"""Schemas of the dimensions, the fact table and the raw inputs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

NAME_KEY = "__name__"

# Series types a sample may have.
COUNTER = "Counter"
COUNTER_INTEGER = "CounterInteger"
GAUGE = "Gauge"
GAUGE_INTEGER = "GaugeInteger"
SERIES_TYPES = (COUNTER, COUNTER_INTEGER, GAUGE, GAUGE_INTEGER)

# Default settings, in seconds: chunks of 8 hours, retention of 90 days.
DEFAULT_CHUNK_INTERVAL_S = 8 * 3600
DEFAULT_RETENTION_S = 90 * 86400

LABEL_STRUCT = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)
LABELS = T.ArrayType(LABEL_STRUCT)

METRIC = T.StructType(
    [
        T.StructField("metric_id", T.IntegerType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("default_chunk_interval", T.BooleanType()),
        T.StructField("chunk_interval_s", T.LongType()),
        T.StructField("retention_s", T.LongType()),
    ]
)
LABEL = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
LABEL_KEY = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("key", T.StringType()),
        T.StructField("value_column_name", T.StringType()),
        T.StructField("id_column_name", T.StringType()),
    ]
)
LABEL_KEY_POSITION = T.StructType(
    [
        T.StructField("metric_name", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("pos", T.IntegerType()),
    ]
)
SERIES = T.StructType(
    [
        T.StructField("series_id", T.LongType()),
        T.StructField("metric_id", T.IntegerType()),
        T.StructField("label_ids", T.ArrayType(T.IntegerType())),
    ]
)
SETTINGS = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value_s", T.LongType())]
)
# Chunk bounds are epoch seconds, so that partition folders do not depend on a time zone.
FACT = T.StructType(
    [
        T.StructField("time", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("sample_kind", T.StringType()),
        T.StructField("series_id", T.LongType()),
        T.StructField("metric_id", T.IntegerType()),
        T.StructField("chunk_start", T.LongType()),
        T.StructField("chunk_end", T.LongType()),
    ]
)
#: A row per series and chunk, and counts of the series that use a label.
SUMMARY = T.StructType(
    [
        T.StructField("metric_id", T.IntegerType()),
        T.StructField("chunk_start", T.LongType()),
        T.StructField("chunk_end", T.LongType()),
        T.StructField("series_id", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("first", T.TimestampType()),
        T.StructField("last", T.TimestampType()),
    ]
)
LABEL_USE = T.StructType(
    [T.StructField("metric_id", T.IntegerType()), T.StructField("id", T.IntegerType()), T.StructField("n", T.LongType())]
)
#: The series of a metric that use a label: 64 of them to a word, bit s for series 64 * word + s.
POSTINGS = T.StructType(
    [
        T.StructField("metric_id", T.IntegerType()),
        T.StructField("id", T.IntegerType()),
        T.StructField("word", T.LongType()),
        T.StructField("bits", T.LongType()),
    ]
)
BOOKMARK = T.StructType(
    [T.StructField("target", T.StringType()), T.StructField("last_scrape", T.LongType())]
)
TARGET = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("labels", LABELS),
        T.StructField("last_scrape", T.LongType()),
    ]
)
EXPOSITION_DOC = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("scrape_ts", T.LongType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)
POD = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("namespace", T.StringType()),
        T.StructField("pod_ip", T.StringType()),
        T.StructField("host_ip", T.StringType()),
        T.StructField("phase", T.StringType()),
        T.StructField("annotations", T.MapType(T.StringType(), T.StringType())),
    ]
)


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """The few rows a driver knows, as a local table: no Python worker makes them, and joins with an
    empty one are left out of the plan."""
    fields = to_arrow_schema(schema)
    columns = list(zip(*rows)) or [()] * len(fields)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)
    return spark.createDataFrame(table, schema)


@dataclass(frozen=True)
class Catalog:
    """The dimensions as DataFrames. Operators take one and return a changed copy."""

    metric: DataFrame
    label: DataFrame
    label_key: DataFrame
    label_key_position: DataFrame
    series: DataFrame
    settings: DataFrame

    @staticmethod
    def empty(spark: SparkSession) -> "Catalog":
        return Catalog(
            metric=local_rows(spark, [], METRIC),
            label=local_rows(spark, [], LABEL),
            label_key=local_rows(spark, [], LABEL_KEY),
            label_key_position=local_rows(spark, [], LABEL_KEY_POSITION),
            series=local_rows(spark, [], SERIES),
            settings=default_settings(spark),
        )

    def with_(self, **frames: DataFrame) -> "Catalog":
        return replace(self, **frames)


def default_settings(spark: SparkSession) -> DataFrame:
    return local_rows(
        spark,
        [
            ("chunk_interval", DEFAULT_CHUNK_INTERVAL_S),
            ("retention_period", DEFAULT_RETENTION_S),
        ],
        SETTINGS,
    )
