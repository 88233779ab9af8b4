"""The rule on old samples.

A sample with its own time is kept if that is at or after the later of the target's previous
scrape and 300 s before this scrape; a sample without one is always kept. The bookmark moves
with every scrape, failed ones included, because it is set before the outcome is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.operators.ordered import previous_in_order

MAX_AGE_S = 300
BUCKET_S = 3600


def oldest_accepted(previous_scrape: Column, scrape_ts: Column) -> Column:
    """In seconds. ``greatest`` skips a null: a target without an earlier scrape."""
    return F.greatest(previous_scrape, scrape_ts - MAX_AGE_S)


def bookmarks(scrapes: DataFrame, initial: DataFrame | None = None) -> DataFrame:
    """Add ``min_ts`` to scrapes of ``doc_id, target, scrape_ts``.

    ``initial`` (``target, last_scrape``) holds bookmarks from before: of an earlier batch, or
    the time a target was created.
    """
    placed = previous_in_order(scrapes, "target", ["scrape_ts", "doc_id"], ["scrape_ts"], BUCKET_S)
    previous = F.col("prev_scrape_ts")
    if initial is not None:
        placed = placed.join(initial.select("target", "last_scrape"), "target", "left")
        previous = F.coalesce(previous, F.col("last_scrape"))
    return placed.withColumn("min_ts", oldest_accepted(previous, F.col("scrape_ts"))).select(*scrapes.columns, "min_ts")


def last_scrapes(scrapes: DataFrame, initial: DataFrame | None = None) -> DataFrame:
    """The bookmark each target is left with."""
    rows = scrapes.select("target", F.col("scrape_ts").alias("last_scrape"))
    if initial is not None:
        rows = rows.unionByName(initial.select("target", "last_scrape"))
    return rows.groupBy("target").agg(F.max("last_scrape").alias("last_scrape"))


def is_recent(ts: Column, min_ts: Column) -> Column:
    return ts.isNull() | (ts >= min_ts)


def age_filter(samples: DataFrame, limits: DataFrame) -> DataFrame:
    """Keep recent samples of ``doc_id, ts, scrape_ts``, given ``doc_id, min_ts``.

    Most samples carry no time of their own, and pass without a join; of the others, those
    older than the fixed age are dropped at once, and the rest meet the bookmarks. Neither
    the dumps nor the bulk of the samples are shuffled. ``samples`` is read twice, so it
    should be a stored table.
    """
    untimed = samples.filter(F.col("ts").isNull())
    timed = samples.filter(F.col("ts") >= F.col("scrape_ts") - MAX_AGE_S)
    recent = timed.join(limits.select("doc_id", "min_ts"), "doc_id").filter(is_recent(F.col("ts"), F.col("min_ts")))
    return untimed.unionByName(recent.select(*samples.columns))
