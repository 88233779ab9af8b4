"""The set of scrape targets, kept up to date from change logs and snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.operators.ordered import previous_in_order
from metricspark.sources.pods import STANDARD_NAMESPACE, target_of

BUCKET = 100_000
TARGET_COLUMNS = ["name", "url", "labels", "last_scrape"]


def target_changes(events: DataFrame, own: str, enabled: Sequence[str] | None = None) -> DataFrame:
    """Pod events to ``seq, event_s, name, target``: the target an event leaves, or null.

    Deleted pods and pods that are no target leave none; bookmarks and nameless pods are
    left out.
    """
    enabled = [own, STANDARD_NAMESPACE] if enabled is None else enabled
    live = F.when(F.col("type") != "DELETED", target_of(F.col("pod"), own, enabled))
    return events.filter(F.col("type").isin("ADDED", "MODIFIED", "DELETED") & F.col("pod.name").isNotNull()).select(
        "seq", F.unix_seconds("event_time").alias("event_s"), F.col("pod.name").alias("name"), live.alias("target")
    )


def fold_targets(events: DataFrame, own: str, enabled: Sequence[str] | None = None, before: DataFrame | None = None) -> DataFrame:
    """The targets after all events: ``name, url, labels, last_scrape``.

    The last event of a pod decides. Unchanged metadata keeps the bookmark; a change, or a
    return after removal, sets it to the time of the event. ``before`` are the targets at the
    start, whose bookmarks last as long as their metadata.
    """
    log = target_changes(events, own, enabled)
    if before is not None:
        start = before.select(
            F.lit(-1).cast("bigint").alias("seq"), F.col("last_scrape").alias("event_s"), "name",
            F.struct("name", "url", "labels").alias("target"),
        )
        log = log.unionByName(start)
    placed = previous_in_order(log, "name", ["seq"], ["target"], BUCKET)
    changed = F.when(~F.col("target").eqNullSafe(F.col("prev_target")), F.col("seq"))
    return (
        placed.groupBy("name")
        .agg(F.max_by("target", "seq").alias("t"), F.max_by("event_s", changed).alias("last_scrape"))
        .filter("t IS NOT NULL")
        .select("name", "t.url", "t.labels", "last_scrape")
    )


def refresh_targets(before: DataFrame, snapshot: DataFrame, now_s: int) -> DataFrame:
    """Replace all targets by a snapshot (``name, url, labels``); a bookmark stays where the
    metadata is equal and is ``now`` elsewhere."""
    old = before.select("name", "url", "labels", "last_scrape")
    same = F.struct(F.col("n.url"), F.col("n.labels")) == F.struct(F.col("o.url"), F.col("o.labels"))
    return (
        snapshot.alias("n")
        .join(old.alias("o"), "name", "left")
        .select(
            "name", "n.url", "n.labels",
            F.when(same, F.col("o.last_scrape")).otherwise(F.lit(now_s)).cast("bigint").alias("last_scrape"),
        )
    )
