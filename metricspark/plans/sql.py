"""Spark SQL over a store: views of its tables and metrics, and functions on labels."""

from __future__ import annotations

from metricspark.functions.values import NORMAL_NAN, STALE
from metricspark.operators import views
from metricspark.plans.store import DIMENSIONS, MetricStore

#: Parameters, result and body of each function. Arrays hold 0 where a key is not set.
SCALAR_FUNCTIONS = {
    # The text of a label id; null for 0, null and ids not known.
    "val": ("label_id INT", "STRING", "SELECT max(value) FROM label WHERE id = label_id"),
    # The array position of a key of a metric; null if it has no such key.
    "label_key_position_of": (
        "of_metric STRING, of_key STRING", "INT",
        "SELECT max(pos) FROM label_key_position WHERE metric_name = of_metric AND key = of_key",
    ),
    "label_contains": ("labels ARRAY<INT>, ids ARRAY<INT>", "BOOLEAN", "size(array_except(ids, labels)) = 0"),
    "label_eq": (
        "a ARRAY<INT>, b ARRAY<INT>", "BOOLEAN",
        "size(a) = size(b) AND size(array_except(slice(b, 2, greatest(size(b) - 1, 0)), a)) = 0",
    ),
    "is_stale_marker": ("kind STRING", "BOOLEAN", f"kind = '{STALE}'"),
    "is_normal_nan": ("kind STRING", "BOOLEAN", f"kind = '{NORMAL_NAN}'"),
}
#: The labels of a series in the order of their positions.
_PAIRS = "array_sort(collect_list(struct(e.at, l.key, l.value)))"
#: The same for functions that return a table.
TABLE_FUNCTIONS = {
    # Keys, values and JSON text of each series of a metric.
    "labels_of_series": (
        "of_metric STRING", "series_id BIGINT, keys ARRAY<STRING>, vals ARRAY<STRING>, labels STRING",
        f"""
        SELECT s.series_id, {_PAIRS}.key, {_PAIRS}.value, to_json(map_from_arrays({_PAIRS}.key, {_PAIRS}.value))
        FROM metric m JOIN series s ON s.metric_id = m.metric_id
        JOIN LATERAL posexplode(s.label_ids) AS e(at, label_id) JOIN label l ON l.id = e.label_id
        WHERE m.metric_name = of_metric GROUP BY s.series_id""",
    ),
    # Ids of the labels of a key that equal a text (=) or match a regular expression (=~).
    "matcher": (
        "of_key STRING, operator STRING, pattern STRING", "id INT",
        """
        SELECT id FROM label WHERE key = of_key
        AND CASE operator WHEN '=' THEN value = pattern WHEN '=~' THEN value RLIKE pattern END""",
    ),
}


def register(store: MetricStore) -> list[str]:
    """Register the store's newest version with its session; the names of the metric views.

    Views: the dimensions, ``facts``, ``chunk_summary``, and for every metric its table name with
    ``time, value, series_id, labels`` and an id column per key, and ``<table>_series`` with a
    value column per key. Functions: see ``SCALAR_FUNCTIONS`` and ``TABLE_FUNCTIONS``. They are
    plain SQL, so a query that uses them is one plan for Spark. Register again to see later
    versions.
    """
    catalog, facts, spark = store.catalog(), store.facts(), store.spark
    for name in DIMENSIONS:
        getattr(catalog, name).createOrReplaceTempView(name)
    facts.createOrReplaceTempView("facts")
    store.summary().createOrReplaceTempView("chunk_summary")
    for name, (parameters, result, body) in SCALAR_FUNCTIONS.items():
        body = f"({body})" if body.startswith("SELECT") else body
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    for name, (parameters, result, body) in TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({result}) RETURN {body}")
    made = []
    # A view per metric: as many as the store has metrics.
    for row in catalog.metric.select("metric_id", "metric_name", "table_name").orderBy("table_name").collect():
        mine = store.facts(row["metric_id"])
        views.metric_view(catalog, mine, row["metric_name"]).createOrReplaceTempView(f"`{row['table_name']}`")
        views.series_view(catalog, row["metric_name"]).createOrReplaceTempView(f"`{row['table_name']}_series`")
        made.append(row["table_name"])
    return made
