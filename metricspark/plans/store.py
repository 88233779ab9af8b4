"""The stored form: dimension tables and one chunked fact table, written with parquet.

Every change to a store is a version of its log (see ``manifest``): a batch, a merge of chunks,
a retention run, new settings. Its files lie under its number and are never changed.

``<root>/<dimension>/<version>`` holds the rows a version adds to a dimension. Small parts are
merged into larger ones, which for labels, series and postings lie in buckets by a hash of their
key, so that a batch reads those buckets only that its own keys fall in.
``<root>/samples/seq=<version>/metric_id=…/chunk_start=…/chunk_end=…`` holds the facts, and
``<root>/summary/seq=<version>`` one row per series and chunk of them. ``label_use`` counts the
series that use a label, in changes that add up.

A batch is known by its writer, the writer's batch id and a digest of its rows. A batch that is
committed is not written again, even if its chunks were merged since; other rows under the same
identity are refused.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricspark.operators.postings import postings
from metricspark.operators.report import REPORT, added_up
from metricspark.operators.retention import CHUNK, Retention, chunk_summary, drop_old, label_use, metric_limit, period_limits
from metricspark.plans.ingest import ingest, staged
from metricspark.plans.manifest import ADD, COMMIT, DROP, MANUAL, Manifest, chunk_rows, part
from metricspark.schema import (
    BOOKMARK,
    FACT,
    LABEL,
    LABEL_KEY,
    LABEL_KEY_POSITION,
    LABEL_USE,
    METRIC,
    POSTINGS,
    SERIES,
    SETTINGS,
    SUMMARY,
    Catalog,
    default_settings,
    local_rows,
)
from metricspark.session import durable, hadoop_path, scratch, together

DIMENSIONS = {
    "metric": METRIC,
    "label": LABEL,
    "label_key": LABEL_KEY,
    "label_key_position": LABEL_KEY_POSITION,
    "series": SERIES,
    "settings": SETTINGS,
}
TABLES = DIMENSIONS | {"label_use": LABEL_USE, "postings": POSTINGS, "bookmarks": BOOKMARK, "report": REPORT}
#: The key by which merged parts are bucketed, and the column of ids that are given.
BUCKET_KEYS = {"label": ["key", "value"], "series": ["metric_id", "label_ids"], "postings": ["id"]}
ID_COLUMNS = {"metric": "metric_id", "label": "id", "label_key": "id", "series": "series_id"}
BUCKETS = 64
SAMPLES = "samples"
#: Parts of one level of a table that are merged into one of the next.
MERGE = 16
_SEQ = T.StructField("seq", T.LongType())
_BUCKET = T.StructField("bucket", T.IntegerType())


class OtherBatch(ValueError):
    """Rows under the identity of a batch that was committed with other rows."""


@dataclass(frozen=True)
class Written:
    """What a batch stored: rows in all, and as ``metric_name, rows`` what each metric took."""

    rows: int
    by_metric: DataFrame


def batch_digest(rows: DataFrame) -> str:
    """Tells the rows of two batches apart, whatever their order and partitions."""
    return _digest_text(rows.select(_row_hash(rows, rows.columns).alias("h")).agg(*_hash_sums("h")).first())


def _row_hash(rows: DataFrame, columns: Sequence[str]) -> Column:
    return F.xxhash64(*(F.to_json(c) if isinstance(rows.schema[c].dataType, T.MapType) else F.col(f"`{c}`") for c in sorted(columns)))


def _hash_sums(h: str) -> list[Column]:
    return [F.count(h).alias("n"), F.bit_xor(h).alias("x"), F.sum(F.pmod(h, F.lit(1 << 31))).alias("s")]


def _digest_text(found: Mapping[str, int | None]) -> str:
    return f"{found['n']}:{found['x'] or 0}:{found['s'] or 0}"


class MetricStore:
    """Reads and writes one store. There is one writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = Manifest(spark, self.root)

    # -- commits ---------------------------------------------------------------------------

    def commits(self) -> DataFrame:
        """One row per committed batch: its number, writer, batch id, and rows parsed and written."""
        rows = self.log.history().where(F.col("action") == COMMIT)
        return rows.select(F.col("version").alias("seq"), "writer", "batch_id", "digest", "parsed", "written")

    def outcomes(self) -> DataFrame:
        """``writer, batch_id, metric_id, rows``: what each batch stored in each metric."""
        log = self.log.history()
        added = log.where((F.col("action") == ADD) & (F.col("part_of") == SAMPLES))
        per_metric = added.groupBy("version", "metric_id").agg(F.sum("n").alias("rows"))
        batches = log.where(F.col("action") == COMMIT).select("version", "writer", "batch_id")
        return batches.join(per_metric, "version").select("writer", "batch_id", "metric_id", "rows")

    def committed(self, writer: str, batch_id: int, digest: str | None = None) -> dict | None:
        """The commit of a batch, or None. With a ``digest``, a batch that was committed with
        another one raises :class:`OtherBatch`."""
        done = self.log.committed(writer, batch_id)
        if done and digest is not None and done["digest"] not in (None, digest):
            raise OtherBatch(f"batch {batch_id} of {writer!r} is committed with other rows")
        return done

    def next_version(self) -> int:
        return self.log.version() + 1

    # -- dimensions ------------------------------------------------------------------------

    def _read_parts(self, name: str, parts: list[dict], buckets: list[int] | None = None) -> DataFrame:
        """Parts of a table; of those in buckets, only the given ones."""
        out = None
        for bucketed in (False, True):
            paths = [f"{self.root}/{name}/{p['seq']}" for p in parts if _bucketed(name, p["level"]) == bucketed]
            if not paths:
                continue
            schema = T.StructType([*TABLES[name].fields, _BUCKET]) if bucketed else TABLES[name]
            rows = self.spark.read.schema(schema).parquet(*paths)
            if bucketed and buckets is not None:
                rows = rows.where(F.col("bucket").isin(buckets))
            rows = rows.select(TABLES[name].names)
            out = rows if out is None else out.unionByName(rows)
        return local_rows(self.spark, [], TABLES[name]) if out is None else out

    def table(self, name: str) -> DataFrame:
        """The rows of a dimension in force."""
        return self._read_parts(name, self.log.state().of(name).to_pylist())

    def find(self, name: str, keys: DataFrame) -> DataFrame:
        """The rows of a table that hold the given keys, from the buckets they fall in. The
        stored rows are the streamed side of a semi join, so they are not shuffled as long as
        the keys fit a broadcast by Spark's own bound."""
        if name not in BUCKET_KEYS:
            return self.table(name).join(keys, keys.columns, "left_semi")
        parts = self.log.state().of(name).to_pylist()
        if not parts:
            return self._read_parts(name, parts)
        buckets = None
        if any(_bucketed(name, p["level"]) for p in parts):
            # At most BUCKETS numbers.
            buckets = [r["b"] for r in keys.select(_bucket_of(name).alias("b")).distinct().collect()]
        return self._read_parts(name, parts, buckets).join(keys, keys.columns, "left_semi")

    def catalog(self) -> Catalog:
        """The dimensions in force, of committed batches."""
        frames = {name: self.table(name) for name in DIMENSIONS}
        if not self.log.state().of("settings").num_rows:
            frames["settings"] = default_settings(self.spark)
        return Catalog(**frames)

    def report(self) -> DataFrame:
        """The counters of all ingested dumps, a row per interval of their scrapes. They are
        committed with their batch, so each batch counts once, however often it was tried."""
        return added_up(self.table("report"))

    def bookmarks(self) -> DataFrame:
        """When each target was last scraped."""
        return self.table("bookmarks")

    def _write_part(self, name: str, rows: DataFrame, seq: int, level: int = 0) -> DataFrame:
        path, schema = f"{self.root}/{name}/{seq}", TABLES[name]
        rows = rows.select(*schema.names)
        if _bucketed(name, level):
            placed = rows.withColumn("bucket", _bucket_of(name)).hint("rebalance", "bucket")
            placed.write.mode("overwrite").partitionBy("bucket").parquet(path)
        else:
            rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def _added_part(self, name: str, rows: DataFrame, seq: int, level: int = 0) -> list[dict]:
        """Write a part; its log row, none if it is empty."""
        return self._part_row(name, self._write_part(name, rows, seq, level), seq, level)

    def _part_row(self, name: str, written: DataFrame, seq: int, level: int = 0) -> list[dict]:
        ids = ID_COLUMNS.get(name)
        found = written.agg(F.count(F.lit(1)).alias("n"), (F.max(ids) if ids else F.lit(None)).cast("bigint").alias("high")).first()
        # Ids of rows that are dropped are not given again.
        high = max(found["high"] or 0, self.log.state().high(name)) if ids else None
        return [part(ADD, name, seq, found["n"], level, high)] if found["n"] or high else []

    def _dropped_parts(self, name: str) -> list[dict]:
        return chunk_rows(DROP, name, self.log.state().of(name))

    def report_part(self, rows: DataFrame, seq: int) -> list[dict]:
        """Write what a batch adds to the report; its log rows."""
        return self._added_part("report", rows, seq)

    def replaced_part(self, name: str, rows: DataFrame, seq: int) -> list[dict]:
        """Write a whole table as one part; log rows that put it in place of the parts in force."""
        return self._added_part(name, rows, seq) + self._dropped_parts(name)

    def replace_catalog(self, catalog: Catalog) -> None:
        """Put other dimensions in place of those in force. Tables that are the same object as
        before are written as well; label counts are taken anew from the series."""
        version = self.next_version()
        steps = [lambda n=name: self._added_part(n, getattr(catalog, n), version) for name in DIMENSIONS]
        steps.append(lambda: self._added_part("label_use", label_use(catalog.series), version))
        steps.append(lambda: self._added_part("postings", postings(catalog.series), version))
        added = together(self.spark, *steps)
        dropped = [row for name in [*DIMENSIONS, "label_use", "postings"] for row in self._dropped_parts(name)]
        self.log.publish(version, self.log.frame([row for rows in added for row in rows] + dropped))

    def merge_parts(self, least: int | None = None) -> None:
        """Merge small parts of the tables, level by level, so that a table never has more than
        ``least`` parts of a level, ``MERGE`` if not given."""
        least = MERGE if least is None else least
        state = self.log.state()
        for name in TABLES:
            parts = state.of(name).to_pylist()
            for level in sorted({p["level"] for p in parts}):
                small = [p for p in parts if p["level"] == level]
                if len(small) < least:
                    continue
                version, rows = self.next_version(), self._read_parts(name, small)
                if name == "label_use":
                    rows = rows.groupBy("metric_id", "id").agg(F.sum("n").alias("n")).where("n <> 0")
                if name == "report":
                    rows = added_up(rows)
                if name == "postings":
                    rows = rows.groupBy("metric_id", "id", "word").agg(F.bit_or("bits").alias("bits"))
                added = self._added_part(name, rows, version, level + 1)
                dropped = [part(DROP, name, p["seq"], p["n"], level) for p in small]
                self.log.publish(version, self.log.frame(added + dropped))

    # -- facts -----------------------------------------------------------------------------

    def _paths(self, parts: pa.Table) -> list[str]:
        """Folders of live parts: whole versions where all they wrote is live, else chunks."""
        if not parts.num_rows:
            return []
        live = parts.group_by(["seq", "parts"]).aggregate([("n", "count")])
        whole = [s for s, n, k in zip(live["seq"].to_pylist(), live["parts"].to_pylist(), live["n_count"].to_pylist()) if n == k]
        cut = parts.filter(pc.invert(pc.is_in(parts["seq"], pa.array(whole, pa.int64()))))
        return [f"{self.root}/{SAMPLES}/seq={s}" for s in whole] + [f"{self.root}/{SAMPLES}/{_chunk_folder(p)}" for p in cut.to_pylist()]

    def _read_facts(self, parts: pa.Table) -> DataFrame:
        paths = self._paths(parts)
        if not paths:
            return local_rows(self.spark, [], FACT)
        schema = T.StructType([*FACT.fields, _SEQ])
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{SAMPLES}").parquet(*paths).drop("seq")

    def facts(self, metric_id: int | None = None) -> DataFrame:
        """The facts of the newest version, of one metric or of all. A reader keeps the version
        it began with, whatever is merged or dropped meanwhile, until :meth:`vacuum`."""
        return self._read_facts(self.log.state().of(SAMPLES, metric_id))

    def summary(self) -> DataFrame:
        """``metric_id, chunk_start, chunk_end, series_id, n, first, last`` of the live facts."""
        parts = self.log.state().of(SAMPLES)
        if not parts.num_rows:
            return local_rows(self.spark, [], SUMMARY)
        columns = [f.name for f in SUMMARY.fields]
        counted = parts.group_by(["seq", "parts"]).aggregate([("n", "count")]).to_pylist()
        out = None
        for whole in (True, False):
            seqs = [p["seq"] for p in counted if (p["parts"] == p["n_count"]) == whole]
            if not seqs:
                continue
            rows = self.spark.read.schema(T.StructType([*SUMMARY.fields, _SEQ])).option("basePath", f"{self.root}/summary").parquet(
                *(f"{self.root}/summary/seq={s}" for s in seqs)
            )
            if not whole:
                live = parts.filter(pc.is_in(parts["seq"], pa.array(seqs, pa.int64())))
                rows = rows.join(self.log.frame(live).select("seq", *CHUNK), ["seq", *CHUNK], "left_semi")
            out = rows.select(columns) if out is None else out.unionByName(rows.select(columns))
        return out

    def _write_facts(self, facts: DataFrame, seq: int) -> list[dict]:
        """Write facts and their summary as parts of a version; their log rows.

        The rebalance groups rows by chunk and cuts a chunk too big for one task, so a hot
        metric does not end in one writer; small chunks share tasks. Rows are sorted by series
        and time, which the parquet statistics then prune by.
        """
        folder = f"{self.root}/{SAMPLES}/seq={seq}"
        (
            facts.select(*[f.name for f in FACT.fields])
            .hint("rebalance", "metric_id", "chunk_start")
            .sortWithinPartitions(*CHUNK, "series_id", "time")
            .write.mode("overwrite")
            .partitionBy(*CHUNK)
            .parquet(folder)
        )
        return self._write_summary(chunk_summary(self.spark.read.schema(FACT).parquet(folder)), seq)

    def _write_summary(self, summary: DataFrame, seq: int) -> list[dict]:
        path = f"{self.root}/summary/seq={seq}"
        summary.write.mode("overwrite").parquet(path)
        held = self.spark.read.schema(SUMMARY).parquet(path)
        # A row per chunk the version writes to.
        rows = [r.asDict() for r in held.groupBy(*CHUNK).agg(F.sum("n").alias("n")).collect()]
        return [r | {"action": ADD, "part_of": SAMPLES, "seq": seq, "parts": len(rows), "level": 0} for r in rows]

    def write_batch(self, samples: DataFrame, batch_id: int, writer: str = MANUAL) -> Written:
        """Ingest samples as one batch and commit it; rows stored, by metric. A batch that is
        committed already is left as it is. The samples are computed once, and their digest as
        they are written."""
        with scratch(self.spark):
            sums = Observation()
            hashed = samples.withColumn("_hash", _row_hash(samples, ["name", "labels", "value", "time"]))
            samples = staged(hashed.observe(sums, *_hash_sums("_hash")))
            digest = _digest_text(sums.get)
            done = self.committed(writer, batch_id, digest)
            if done:
                return self._outcome(done["version"], done["written"])
            version = self.next_version()
            rows = self.stage_batch(samples, version)
        written = _facts_in(rows)
        self.commit(version, rows, writer, batch_id, digest, written, written)
        return self._outcome(version, written)

    def stage_batch(self, samples: DataFrame, seq: int) -> list[dict]:
        """Write a batch under a number, dimensions first, without the commit; its log rows."""
        state = self.log.state()
        with scratch(self.spark):
            made = ingest(
                samples, self.catalog(), persist=lambda rows, name: self._write_part(name, rows, seq),
                find=self.find, highs={name: state.high(name) for name in ID_COLUMNS},
            )
            new = made.added["series"]
            steps = [
                lambda: self._write_facts(made.facts, seq),
                lambda: self._added_part("label_use", label_use(new), seq),
                lambda: self._added_part("postings", postings(new), seq),
                *(lambda n=n, rows=rows: self._part_row(n, rows, seq) for n, rows in made.added.items()),
            ]
            return [row for rows in together(self.spark, *steps) for row in rows if row["n"]]

    def commit(self, version: int, rows: list[dict], writer: str, batch_id: int, digest: str, parsed: int, written: int) -> None:
        done = {"action": COMMIT, "writer": writer, "batch_id": batch_id, "digest": digest, "parsed": parsed, "written": written}
        self.log.publish(version, self.log.frame([*rows, done | {"version": version}]))
        self.merge_parts()

    def _outcome(self, version: int, written: int) -> Written:
        added = self.log.history().where((F.col("version") == version) & (F.col("part_of") == SAMPLES) & (F.col("action") == ADD))
        per_metric = added.groupBy("metric_id").agg(F.sum("n").alias("rows"))
        return Written(written, per_metric.join(self.table("metric"), "metric_id").select("metric_name", "rows"))

    # -- chunks ----------------------------------------------------------------------------

    def compact_chunks(self, closed_before_s: int | None = None) -> int:
        """Merge the chunks that lie in several parts into one sorted part each, as one version.

        ``closed_before_s`` leaves out chunks that end later and may still grow. Readers see the
        old parts or the merged one, never fewer rows; the summary is merged without reading
        facts. Returns the number of chunks.
        """
        parts = self.log.state().of(SAMPLES)
        if closed_before_s is not None:
            parts = parts.filter(pc.less_equal(parts["chunk_end"], closed_before_s))
        counted = parts.group_by(CHUNK).aggregate([("seq", "count")])
        several = counted.filter(pc.greater(counted["seq_count"], 1))
        if not several.num_rows:
            return 0
        self._rewrite(parts.join(several.select(CHUNK), CHUNK, join_type="left semi"), None)
        return several.num_rows

    def _rewrite(self, old: pa.Table, late: DataFrame | None, commit: Callable[[int], list[dict]] = lambda version: []) -> None:
        version = self.next_version()
        with scratch(self.spark):
            facts = self._read_facts(old)
            facts = facts if late is None else facts.unionByName(late.select(*facts.columns))
            added = self._write_facts(facts, version)
        self.log.publish(version, self.log.frame(added + chunk_rows(DROP, SAMPLES, old) + commit(version)))

    def rewrite_chunks(self, late: DataFrame, batch_id: int, writer: str = MANUAL) -> int:
        """Merge a batch of late facts into the chunks they fall in, as one version.

        Only the chunks a late row belongs to are read and written. The batch has an identity
        like any other, so a second run adds nothing. Returns the number of chunks, 0 for a
        batch that is committed already or has no rows.
        """
        columns = [f.name for f in FACT.fields]
        late = durable(late.select(*columns), "late")
        digest = batch_digest(late)
        if self.committed(writer, batch_id, digest):
            return 0
        touched = late.groupBy(*CHUNK).agg(F.count(F.lit(1)).alias("late")).toArrow()
        parts = self.log.state().of(SAMPLES)
        old = parts.join(touched.select(CHUNK), CHUNK, join_type="left semi") if touched.num_rows and parts.num_rows else parts.slice(0, 0)
        n = pc.sum(touched["late"]).as_py() or 0
        done = {"action": COMMIT, "writer": writer, "batch_id": batch_id, "digest": digest, "parsed": n, "written": n}
        self._rewrite(old, late, lambda version: [done | {"version": version}])
        return touched.num_rows

    # -- retention -------------------------------------------------------------------------

    def apply_retention(self, now_s: int, scope: str = "all") -> int:
        """Drop expired chunks, and the series and labels only they used, as one version. No
        fact is read. Returns the number of chunks."""
        return self._retain(lambda catalog: period_limits(catalog, now_s), scope)

    def drop_metric_chunks(self, metric_name: str, older_than_s: int, scope: str = "all") -> int:
        """The same for one metric and a given time."""
        return self._retain(lambda catalog: metric_limit(catalog, metric_name, older_than_s), scope)

    def retention(self, limits: DataFrame, scope: str = "all") -> Retention:
        return drop_old(self.catalog(), self.summary(), self.table("label_use"), limits, scope)

    def _retain(self, limits: Callable[[Catalog], DataFrame], scope: str) -> int:
        version, state = self.next_version(), self.log.state()
        with scratch(self.spark):
            result = self.retention(limits(self.catalog()), scope)
            # A row per chunk that goes.
            gone = result.dropped_chunks.toArrow()
            if not gone.num_rows:
                return 0
            dropped = state.of(SAMPLES).join(gone, CHUNK, join_type="left semi")
            added = together(
                self.spark,
                *(lambda n=n: self._added_part(n, getattr(result.catalog, n), version, self._top_level(n)) for n in ("series", "label")),
                lambda: self._added_part("label_use", result.use_change, version),
            )
            rows = [row for rows in added for row in rows] + chunk_rows(DROP, SAMPLES, dropped)
            rows += [row for name in ("series", "label") for row in self._dropped_parts(name)]
            self.log.publish(version, self.log.frame(rows))
        return gone.num_rows

    def _top_level(self, name: str) -> int:
        return max(self.log.state().of(name)["level"].to_pylist(), default=0)

    # -- cleaning up -----------------------------------------------------------------------

    def vacuum(self) -> int:
        """Delete files no live part refers to: of merged and dropped parts and of failed
        attempts. Readers of older versions must be done. Returns the number of folders."""
        state = self.log.state()
        deleted = 0
        for name in [*TABLES, SAMPLES, "summary"]:
            live = set(state.of(SAMPLES if name == "summary" else name)["seq"].to_pylist())
            for path, number in self._numbered(name):
                if number not in live:
                    deleted += self._delete(path)
        kept = {f"{self.root}/{SAMPLES}/{_chunk_folder(p)}" for p in state.of(SAMPLES).to_pylist()}
        counted = state.of(SAMPLES).group_by(["seq", "parts"]).aggregate([("n", "count")]).to_pylist()
        for p in counted:
            if p["parts"] != p["n_count"]:
                for path in self._chunk_folders(f"{self.root}/{SAMPLES}/seq={p['seq']}"):
                    if path not in kept:
                        deleted += self._delete(path)
        return deleted

    def _children(self, folder: str) -> list[str]:
        path, files = hadoop_path(self.spark, folder)
        return [f"{folder}/{s.getPath().getName()}" for s in files.listStatus(path) if s.isDirectory()] if files.exists(path) else []

    def _numbered(self, name: str) -> list[tuple[str, int]]:
        folders = [(path, path.rsplit("/", 1)[1].removeprefix("seq=")) for path in self._children(f"{self.root}/{name}")]
        return [(path, int(number)) for path, number in folders if number.isdigit()]

    def _chunk_folders(self, folder: str) -> list[str]:
        return [c for metric in self._children(folder) for start in self._children(metric) for c in self._children(start)]

    def _delete(self, folder: str) -> bool:
        path, files = hadoop_path(self.spark, folder)
        return files.delete(path, True)


def _bucketed(name: str, level: int) -> bool:
    return name in BUCKET_KEYS and level > 0


def _bucket_of(name: str) -> Column:
    return F.pmod(F.hash(*BUCKET_KEYS[name]), F.lit(BUCKETS))


def _facts_in(rows: list[dict]) -> int:
    return sum(row["n"] for row in rows if row["part_of"] == SAMPLES)


def _chunk_folder(row: dict) -> str:
    return f"seq={row['seq']}/metric_id={row['metric_id']}/chunk_start={row['chunk_start']}/chunk_end={row['chunk_end']}"
