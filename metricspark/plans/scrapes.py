"""A batch of scrape dumps into a store: the whole path from text to facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.functions.labels import with_static_labels
from metricspark.operators.age import age_filter, bookmarks, last_scrapes
from metricspark.operators.remote_write import time_series, write_requests
from metricspark.operators.report import INTERVAL_S, ingest_report
from metricspark.plans.manifest import ADD
from metricspark.plans.store import MANUAL, SAMPLES, MetricStore, batch_digest
from metricspark.session import durable, scratch
from metricspark.sources import split_dumps
from metricspark.sources.exposition import parse_exposition

SINKS = ("table", "write_request")


@dataclass(frozen=True)
class BatchCounts:
    parsed: int
    written: int
    skipped: int


def batch_report(scrapes: DataFrame, parsed: DataFrame, accepted: DataFrame, new_series: int, interval_s: int = INTERVAL_S) -> DataFrame:
    """The counters of one batch by interval: its scrapes and their bytes, samples written, and
    samples too old to be. Series belong to a batch, so new ones count at its last scrape.

    Samples meet the scrapes only as counts per second, which are summed before a shuffle."""
    per_second = lambda rows, name: rows.groupBy("scrape_ts").agg(F.count(F.lit(1)).alias(name))
    counted = per_second(parsed, "parsed").join(per_second(accepted, "samples"), "scrape_ts", "left")
    nothing = F.lit(None).cast("bigint")
    columns = ["scrape_ts", "outcome", "samples", "skipped", "failed", "new_series", "response_bytes"]
    samples = F.coalesce("samples", F.lit(0))
    counts = counted.withColumns({
        "outcome": F.lit(None).cast("string"), "samples": samples, "skipped": F.col("parsed") - samples,
        "failed": nothing, "new_series": nothing, "response_bytes": nothing,
    }).select(columns)
    each = scrapes.withColumns({
        "outcome": F.lit("ok"), "samples": nothing, "skipped": nothing, "failed": nothing, "new_series": nothing,
    }).select(columns)
    last = scrapes.agg(F.max("scrape_ts").alias("scrape_ts")).where("scrape_ts IS NOT NULL").withColumns({
        "outcome": F.lit(None).cast("string"), "samples": nothing, "skipped": nothing, "failed": nothing,
        "new_series": F.lit(new_series).cast("bigint"), "response_bytes": nothing,
    }).select(columns)
    return ingest_report(counts.unionByName(each).unionByName(last), interval_s)


def ingest_dumps(
    store: MetricStore,
    docs: DataFrame,
    batch_id: int,
    static: Sequence[tuple[str, str]] | Mapping[str, str] = (),
    targets: DataFrame | None = None,
    sink: str = "table",
    timestamp_unit: str = "ms",
    writer: str = MANUAL,
) -> BatchCounts:
    """Parse dumps, leave out old samples, add labels, and write to one of two sinks.

    ``docs`` are dumps as rows (``read_exposition``) or, for dumps of any size, their lines
    (``split_dumps.read_lines``); a dump without any line is then no scrape.
    ``targets`` (``name, labels``, and ``last_scrape`` if known) gives each target's labels. The
    later of a target's bookmark and its ``last_scrape``, set to the time it was made, is where
    it starts, so a target that was deleted and made anew starts anew. Parsing is the costly step
    and ingest reads the samples more than once, so they are parsed into a table first. A batch
    that ``writer`` has committed is skipped, and other dumps under its id are refused; one that
    failed replaces what it wrote. The counters of the batch are committed with it, see
    ``MetricStore.report``.
    """
    if sink not in SINKS:
        raise ValueError(f"unknown sink {sink!r}, not one of {SINKS}")
    by_line = "block" in docs.columns
    body = "text" if by_line else "body"
    digest = batch_digest(docs.select("doc_id", "target", "scrape_ts", body))
    done = store.committed(writer, batch_id, digest)
    if done:
        return BatchCounts(done["parsed"], done["written"], done["parsed"] - done["written"])
    seq = store.next_version()
    before = known = store.bookmarks()
    if targets is not None and "last_scrape" in targets.columns:
        made = targets.where("last_scrape IS NOT NULL").select(F.col("name").alias("target"), "last_scrape")
        before = last_scrapes(made.withColumnRenamed("last_scrape", "scrape_ts"), known)
    with scratch(store.spark):
        columns = ("doc_id", "target", "scrape_ts", "line", "name", "labels", "value", "sample_kind", "time", "ts")
        parse = split_dumps.parse_lines if by_line else parse_exposition
        staged = durable(parse(docs, timestamp_unit=timestamp_unit).select(*columns), "parsed")
        sizes = docs.select("doc_id", "target", "scrape_ts", F.octet_length(body).alias("response_bytes"))
        if by_line:
            whole = F.sum(F.col("response_bytes") + 1).alias("response_bytes")
            sizes = sizes.groupBy("doc_id", "target", "scrape_ts").agg(whole)
        scrapes = durable(sizes, "scrapes")
        samples = accepted = age_filter(staged, bookmarks(scrapes.drop("response_bytes"), before))
        target_labels = None
        if targets is not None:
            labels = targets.select(F.col("name").alias("target"), F.col("labels").alias("target_labels"))
            samples = samples.join(labels, "target", "left")
            target_labels = F.col("target_labels")
        if sink == "table":
            labelled = samples.withColumn("labels", with_static_labels(F.col("labels"), static, target_labels))
            rows = store.stage_batch(labelled, seq)
            written = sum(row["n"] for row in rows if row["part_of"] == SAMPLES)
        else:
            folder = f"{store.root}/write_requests/batch_id={seq}"
            write_requests(time_series(samples, static, target_labels)).write.mode("overwrite").parquet(folder)
            rows, written = [], store.spark.read.parquet(folder).count()
        new_series = sum(row["n"] for row in rows if row["part_of"] == "series" and row["action"] == ADD)
        rows += store.report_part(batch_report(scrapes, staged, accepted, new_series), seq)
        rows += store.replaced_part("bookmarks", last_scrapes(scrapes.drop("response_bytes"), before), seq)
        parsed = staged.count()
        store.commit(seq, rows, writer, batch_id, digest, parsed, written)
    return BatchCounts(parsed, written, parsed - written)
