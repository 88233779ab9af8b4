"""Samples to dimensions and facts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.functions.labels import canonical_labels, series_hash
from metricspark.functions.values import sample_kind
from metricspark.operators.dictionary import (
    new_label_keys,
    new_label_positions,
    new_labels,
    new_metrics,
    new_series,
)
from metricspark.operators.encode import encode_labels
from metricspark.operators.settings import chunk_bounds, effective_settings
from metricspark.schema import SERIES, Catalog
from metricspark.session import durable, together


#: The columns that stand for a label list where samples are shuffled.
SET_KEY = ["set_hash", "set_hash2"]
SECOND_SEED = 0x5EED


@dataclass(frozen=True)
class Ingested:
    """The grown catalog, the rows added to each dimension, and the facts."""

    catalog: Catalog
    added: dict[str, DataFrame]
    facts: DataFrame


def set_hashes(name: Column, labels: Column) -> tuple[Column, Column]:
    return series_hash(name, labels), F.xxhash64(F.lit(SECOND_SEED), name, labels)


def staged(samples: DataFrame, *carry: str) -> DataFrame:
    """Samples written once with their kinds, so that what made them does not run for each read."""
    kind = F.col("sample_kind") if "sample_kind" in samples.columns else sample_kind(F.col("value"))
    return durable(samples.select("name", "labels", "value", "time", kind.alias("sample_kind"), *carry), "samples")


def ingest(
    samples: DataFrame,
    catalog: Catalog,
    carry: Sequence[str] = (),
    persist: Callable[[DataFrame, str], DataFrame] = durable,
    find: Callable[[str, DataFrame], DataFrame] | None = None,
    highs: Mapping[str, int] | None = None,
) -> Ingested:
    """Resolve samples of ``name, labels, value, time`` to series, creating what is missing.

    Dictionary work runs on the distinct label lists, which partial aggregation shrinks
    before their only shuffle; only these are put in canonical order, and lists that differ
    in order alone find the same series. The samples themselves are shuffled once, to fetch
    their series id (not at all where the lists' series, written with their true size, fit a
    broadcast by Spark's own bound), and only with a 16-byte key, value and time; a series holding much of
    the data is a skewed key that adaptive execution splits. The key is two hashes of name
    and labels with different seeds; where the distinct lists meet, it is checked, and samples
    of lists that share a key find their series by the lists in canonical order. ``samples`` are read
    twice, so they should be a stored table (:func:`staged`).

    ``carry`` names further sample columns to keep on the facts. ``persist`` writes the new
    rows of a dimension and returns them as read back. ``find(dimension, keys)`` returns the rows
    that hold given keys, and ``highs`` has the highest id of each dimension; without them the
    dimensions of ``catalog`` are read. What is found is small, so stored labels and series
    never go through a shuffle where the batch's own fit a broadcast by Spark's own bound.
    """
    highs = highs or {}
    find = find or (lambda name, keys: getattr(catalog, name).join(keys, keys.columns, "left_semi"))
    keyed = samples.withColumns(dict(zip(SET_KEY, set_hashes(F.col("name"), F.col("labels")))))
    sets = durable(
        keyed.select("name", "labels", *SET_KEY)
        .distinct()
        .select(
            *SET_KEY,
            F.col("name").alias("metric_name"),
            canonical_labels(F.col("name"), F.col("labels")).alias("canonical"),
            F.monotonically_increasing_id().alias("set_id"),
        ),
        "label-sets",
    )
    pairs = sets.select("metric_name", F.inline("canonical"))

    def keys() -> dict[str, DataFrame]:
        positions = persist(new_label_positions(catalog.label_key_position, pairs), "label_key_position")
        return {
            "label_key_position": positions,
            "label_key": persist(new_label_keys(catalog.label_key, positions, highs.get("label_key")), "label_key"),
        }

    def labels() -> dict[str, DataFrame]:
        known = durable(find("label", pairs.select("key", "value").distinct()), "known-labels")
        return {"label": persist(new_labels(known, pairs, highs.get("label")), "label"), "known": known}

    steps = together(
        samples.sparkSession,
        lambda: {"metric": persist(new_metrics(catalog.metric, sets, highs.get("metric")), "metric")},
        labels,
        keys,
        lambda: {"shared": _shared_keys(sets)},
    )
    added = {name: rows for step in steps for name, rows in step.items()}
    shared = added.pop("shared")
    named = added.pop("known").unionByName(added["label"])
    grown = catalog.with_(**{n: getattr(catalog, n).unionByName(rows) for n, rows in added.items()})

    metrics = effective_settings(grown).select("metric_name", "metric_id", "chunk_interval_s")
    positions = durable(grown.label_key_position.join(metrics, "metric_name"), "positions")
    resolved = durable(encode_labels(sets, named, positions, [*SET_KEY, "metric_id", "chunk_interval_s"]), "resolved-sets")
    held = durable(find("series", resolved.select("metric_id", "label_ids").distinct()), "known-series")
    carried = ["set_id", *SET_KEY, "chunk_interval_s"]
    fresh = new_series(held, resolved, highs.get("series"), carried)
    added["series"] = persist(fresh.select(*SERIES.names), "series")
    grown = grown.with_(series=catalog.series.unionByName(added["series"]))
    # A new series of one list, as most are, has it beside its id; the other lists are joined.
    others = durable(held.unionByName(fresh.where("lists > 1").select(*SERIES.names)), "series-of-lists")
    joined = resolved.join(others, ["metric_id", "label_ids"])
    columns = [*carried, "metric_id", "series_id"]
    known = durable(fresh.where("lists = 1").select(*columns).unionByName(joined.select(*columns)), "known-sets")
    return Ingested(grown, added, _facts(keyed, known, sets, shared, carry))


def _shared_keys(sets: DataFrame) -> DataFrame | None:
    """The keys that several label lists have, None if there are none."""
    shared = durable(sets.groupBy(*SET_KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*SET_KEY), "shared-keys")
    return None if shared.isEmpty() else shared


def _facts(keyed: DataFrame, known: DataFrame, sets: DataFrame, shared: DataFrame | None, carry: Sequence[str]) -> DataFrame:
    kind = F.col("sample_kind") if "sample_kind" in keyed.columns else sample_kind(F.col("value"))
    rows = keyed.select("name", "labels", *SET_KEY, "time", "value", kind.alias("sample_kind"), *carry)
    start, end = chunk_bounds(F.col("time"), F.col("chunk_interval_s"))

    def placed(rows: DataFrame, on: list[str], known: DataFrame = known) -> DataFrame:
        series = known.select(*on, "metric_id", "chunk_interval_s", "series_id")
        return rows.select(*on, "time", "value", "sample_kind", *carry).join(series, on).select(
            "time", "value", "sample_kind", "series_id", "metric_id",
            start.alias("chunk_start"), end.alias("chunk_end"), *carry,
        )

    if shared is None:
        return placed(rows, SET_KEY)
    # Lists that differ in order alone have one series.
    identity = ["metric_name", "canonical"]
    lists = sets.join(shared, SET_KEY, "left_semi").select("set_id", *identity)
    named = F.col("name").alias("metric_name"), canonical_labels(F.col("name"), F.col("labels")).alias("canonical")
    whole = placed(
        rows.join(shared, SET_KEY, "left_semi").select("*", *named), identity, known.join(lists, "set_id").dropDuplicates(identity)
    )
    return placed(rows.join(shared, SET_KEY, "left_anti"), SET_KEY).unionByName(whole)
