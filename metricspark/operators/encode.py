"""Label sets to label-id arrays and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.schema import LABELS


#: Positions that are gathered as columns.
COLUMNS = 32


def id_array(slots: Column) -> Column:
    """``array<struct<pos,id>>`` to ids by position, as long as the highest position used;
    positions not used hold 0."""
    at, ids = slots.getField("pos"), slots.getField("id")
    spread = F.transform(
        F.sequence(F.lit(1), F.array_max(at)),
        lambda p: F.coalesce(F.get(ids, F.array_position(at, p).cast("int") - 1), F.lit(0)),
    )
    # Without gaps, which is common, the ids in order are the array.
    return F.when(F.array_max(at) == F.size(slots), F.sort_array(slots).getField("id")).otherwise(spread)


def encode_labels(sets: DataFrame, label_dim: DataFrame, positions: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``set_id, label_ids`` of label sets of ``set_id, metric_name, canonical``, with the columns of
    sets or positions that ``keep`` names, which are carried along so that no join has to fetch them.

    Works on distinct sets, never on samples. A set has few labels, so a group is small;
    a label or metric many sets share is a skewed join key on the left side only, which
    adaptive execution splits. Up to ``COLUMNS`` positions are gathered in a column each, which
    hashes and compiles; lists, of any length, are sorted by set instead.
    """
    own = [c for c in keep if c in sets.columns]
    pairs = sets.select(*dict.fromkeys(["set_id", "metric_name", *own]), F.inline("canonical"))
    slots = pairs.join(label_dim, ["key", "value"]).join(positions, ["metric_name", "key"]).groupBy("set_id", *keep)
    highest = positions.agg(F.max("pos")).first()[0] or 0
    if not 0 < highest <= COLUMNS:
        listed = slots.agg(F.collect_list(F.struct("pos", "id")).alias("slots"))
        return listed.select("set_id", *keep, id_array(F.col("slots")).alias("label_ids"))
    at = [f"at_{p}" for p in range(1, highest + 1)]
    found = slots.agg(
        F.max("pos").alias("last"), *(F.max(F.when(F.col("pos") == p, F.col("id"))).alias(c) for p, c in enumerate(at, 1))
    )
    ids = F.array(*(F.coalesce(c, F.lit(0)) for c in at))
    return found.select("set_id", *keep, F.slice(ids, 1, F.col("last")).alias("label_ids"))


def decode_series(series: DataFrame, label_dim: DataFrame) -> DataFrame:
    """Add ``labels``, the label list in position order, to series. Unset slots fall out."""
    slots = series.select("series_id", F.posexplode("label_ids").alias("pos", "id")).filter("id <> 0")
    named = (
        slots.join(label_dim, "id")
        .groupBy("series_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "key", "value"))).alias("slots"))
        .select("series_id", F.arrays_zip("slots.key", "slots.value").cast(LABELS).alias("labels"))
    )
    return series.join(named, "series_id", "left")


def key_value_arrays(labels: Column) -> tuple[Column, Column]:
    """Two parallel arrays, of keys and of values."""
    return labels.getField("key"), labels.getField("value")


def label_map(labels: Column) -> Column:
    return F.map_from_arrays(*key_value_arrays(labels))
