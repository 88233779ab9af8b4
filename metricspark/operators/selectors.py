"""Label selectors: matchers on one key, and the series and facts they choose.

A label id belongs to one key, and within a metric a key has one position. So "the array
shares an id with this id set" is an equality of one array slot with an id, and a matcher is
a semi or anti join of the series with the dictionary on that slot. Nothing is exploded or
collected, and the size of the id set does not matter; adaptive execution broadcasts it
when it is small.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.functions.labels import labels_from_map
from metricspark.functions.matching import without_name_key
from metricspark.schema import NAME_KEY, Catalog


@dataclass(frozen=True)
class Matcher:
    """Ids of a key's values that equal or match ``pattern``; negative ones must be absent.

    Regular expressions are unanchored, in Java's dialect.
    """

    key: str
    pattern: str
    regex: bool = False
    positive: bool = True

    def condition(self) -> Column:
        value = F.col("value")
        test = value.rlike(self.pattern) if self.regex else value == F.lit(self.pattern)
        return (F.col("key") == F.lit(self.key)) & test

    def ids(self, label_dim: DataFrame) -> DataFrame:
        return label_dim.filter(self.condition()).select("id")


def equal(key: str, value: str) -> Matcher:
    return Matcher(key, value)


def not_equal(key: str, value: str) -> Matcher:
    return Matcher(key, value, positive=False)


def matches(key: str, regex: str) -> Matcher:
    return Matcher(key, regex, regex=True)


def not_matches(key: str, regex: str) -> Matcher:
    return Matcher(key, regex, regex=True, positive=False)


def metric_series(catalog: Catalog, metric_name: str) -> DataFrame:
    """Series of one metric. The id is looked up first (one dictionary row), so that the
    series and facts are pruned by partition and not joined."""
    return catalog.series.filter(F.col("metric_id") == metric_id(catalog, metric_name))


def metric_id(catalog: Catalog, metric_name: str) -> int:
    """Id of a metric; -1, which no series has, if it does not exist."""
    row = catalog.metric.filter(F.col("metric_name") == metric_name).select("metric_id").first()
    return row["metric_id"] if row else -1


def key_positions(catalog: Catalog, metric_name: str) -> dict[str, int]:
    """Position by key of one metric, in position order. A metric has few keys."""
    rows = catalog.label_key_position.filter(F.col("metric_name") == metric_name).collect()
    return {r["key"]: r["pos"] for r in sorted(rows, key=lambda r: r["pos"])}


def slot(labels: Column | str, pos: int) -> Column:
    """The id at a 1-based position: 0 for an inner gap, null past the end."""
    return F.get(labels, F.lit(pos - 1))


def select_series(catalog: Catalog, metric_name: str, *matchers: Matcher) -> DataFrame:
    """Series of a metric that all matchers accept.

    A key the metric does not have matches no id: a positive matcher then accepts nothing and
    a negative one everything.
    """
    positions = key_positions(catalog, metric_name)
    chosen = metric_series(catalog, metric_name)
    for m in matchers:
        pos = positions.get(m.key)
        if pos is None:
            chosen = chosen.filter(F.lit(not m.positive))
            continue
        ids = m.ids(catalog.label).withColumnRenamed("id", "_id")
        how = "left_semi" if m.positive else "left_anti"
        chosen = chosen.join(ids, slot("label_ids", pos) == F.col("_id"), how)
    return chosen


def select_across_metrics(catalog: Catalog, *matchers: Matcher) -> DataFrame:
    """Series of any metric that all matchers accept: positions come from the registry."""
    chosen = catalog.series
    for m in matchers:
        at = (
            catalog.label_key_position.filter(F.col("key") == F.lit(m.key))
            .join(catalog.metric.select("metric_id", "metric_name"), "metric_name")
            .select("metric_id", "pos")
        )
        ids = m.ids(catalog.label).withColumnRenamed("id", "_id")
        how = "left_semi" if m.positive else "left_anti"
        placed = chosen.join(at, "metric_id", "left").withColumn("_slot", F.get("label_ids", F.col("pos") - 1))
        chosen = placed.join(ids, F.col("_slot") == F.col("_id"), how).select(*catalog.series.columns)
    return chosen


def select_containing(catalog: Catalog, metric_name: str, pairs: Mapping[str, str]) -> DataFrame:
    """Series with every listed pair. The metric name is ignored, an unknown pair matches
    nothing, and no pairs match everything."""
    wanted = [equal(k, v) for k, v in pairs.items() if k != NAME_KEY]
    return select_series(catalog, metric_name, *wanted)


def select_equal(catalog: Catalog, metric_name: str, pairs: Mapping[str, str]) -> DataFrame:
    """Series whose array is as long as the pairs plus the name and holds them all. A series
    with an inner gap is longer, so it is never chosen."""
    n = sum(1 for k in pairs if k != NAME_KEY)
    return select_containing(catalog, metric_name, pairs).filter(F.size("label_ids") == n + 1)


def select_equal_exact(catalog: Catalog, metric_name: str, pairs: Mapping[str, str]) -> DataFrame:
    """Series with exactly the pairs, gaps or not."""
    n = sum(1 for k in pairs if k != NAME_KEY)
    set_ids = F.filter("label_ids", lambda i: i != 0)
    return select_containing(catalog, metric_name, pairs).filter(F.size(set_ids) == n + 1)


def matcher_arrays(rows: DataFrame, key: str, pairs: str, label_dim: DataFrame) -> DataFrame:
    """Resolve a map column of each row to its id array: ``key, matcher``.

    The metric name is left out and an unknown pair is -1. Rows without pairs get an empty
    array. ``key`` names a unique column.
    """
    entries = rows.select(key, F.explode(labels_from_map(without_name_key(F.col(pairs)))).alias("p"))
    found = (
        entries.select(key, "p.*")
        .join(label_dim, ["key", "value"], "left")
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.coalesce("id", F.lit(-1)))).alias("matcher"))
    )
    empty = F.array().cast("array<int>")
    return rows.join(found, key, "left").withColumn("matcher", F.coalesce("matcher", empty))


def facts_of(facts: DataFrame, series: DataFrame, metric: int | None = None) -> DataFrame:
    """Facts of the chosen series. With the id of their ``metric``, only its partitions are read."""
    if metric is not None:
        facts = facts.filter(F.col("metric_id") == F.lit(metric))
    return facts.join(series.select("metric_id", "series_id"), ["metric_id", "series_id"], "left_semi")
