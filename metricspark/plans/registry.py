"""Registered queries. Each has a name, a Spark job over the provided tables, and in
``oracles`` the SQL its result must equal."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricspark.functions import matching, naming, values
from metricspark.functions.labels import (
    canonical_labels,
    labels_of,
    labels_text,
    parse_static_labels,
    series_hash,
    with_static_labels,
)
from metricspark.functions.text import format_bytes, micros_of
from metricspark.operators import age, encode, info, postings, remote_write, report, retention, selectors, settings, targets, views
from metricspark.operators.dictionary import get_or_create_metrics
from metricspark.plans import fixtures, sql
from metricspark.plans.ingest import Ingested, ingest, staged
from metricspark.plans.scrapes import ingest_dumps
from metricspark.plans.store import MetricStore, OtherBatch
from metricspark.schema import LABELS, Catalog
from metricspark.session import durable, durable_path, fresh_folder
from metricspark.sources import exposition, label_json, pods, split_dumps
from metricspark.streaming.bookmarks import stream_bookmarks
from metricspark.streaming.ingest import stream_ingest
from metricspark.streaming.report import read_report, stream_report
from metricspark.streaming.targets import stream_targets, target_set

DAY_S = 86400
NOW_S = 1706677200  # 2024-01-31 05:00 UTC
MADE_S = 1705363300  # when the targets of a query are made anew
OWN_NAMESPACE = "own.example"
SPLIT_BYTES = 1 << 18  # of the dump files that queries read by splits

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_BUILT: dict[tuple, object] = {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query. Whole numbers are widened to bigint, as the SQL side has them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        small = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("int", "smallint", "tinyint")]
        return df.withColumns({c: F.col(c).cast("bigint") for c in small}) if small else df

    _QUERIES[fn.__name__] = run
    return run


def _once(kind: str, spark: SparkSession, sf_dir: str, build: Callable[[], object]) -> object:
    """Stored tables are written once per application and data folder, as a store would be."""
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def forget_stores() -> None:
    _BUILT.clear()


def write_event_store(spark: SparkSession, sf_dir: str) -> MetricStore:
    """Events ingested into a new store: chunks of 5 days, of one day for one metric."""
    store = MetricStore(spark, fresh_folder(spark, "events-store"))
    catalog = settings.set_default(store.catalog(), settings.CHUNK_INTERVAL, 5 * DAY_S)
    catalog = settings.set_metric(catalog, settings.CHUNK_INTERVAL, "view", DAY_S)
    store.replace_catalog(catalog)
    store.write_batch(fixtures.event_samples(spark, sf_dir), 0)
    return store


def event_store(spark: SparkSession, sf_dir: str) -> MetricStore:
    return _once("events", spark, sf_dir, lambda: write_event_store(spark, sf_dir))


def plain_events(spark: SparkSession, sf_dir: str) -> Ingested:
    """Events on default settings, with metric ids in name order."""
    return _once("plain", spark, sf_dir, lambda: _ingested(fixtures.event_samples(spark, sf_dir)))


def _ingested(samples: DataFrame) -> Ingested:
    """Samples ingested on default settings, with facts written, so that reads do not ingest again."""
    made = ingest(staged(samples, "event_id"), Catalog.empty(samples.sparkSession), ["event_id"])
    return replace(made, facts=durable(made.facts, "facts"))


def stored_events(spark: SparkSession, sf_dir: str) -> Ingested:
    """Events as a store holds them: what reads should use."""
    store = event_store(spark, sf_dir)
    return Ingested(store.catalog(), {}, store.facts())


def coarse_events(spark: SparkSession, sf_dir: str) -> Ingested:
    return _once("coarse", spark, sf_dir, lambda: _ingested(fixtures.coarse_samples(spark, sf_dir)))


def write_lineitem_store(spark: SparkSession, sf_dir: str) -> MetricStore:
    store = MetricStore(spark, fresh_folder(spark, "lineitem-store"))
    store.replace_catalog(settings.set_default(store.catalog(), settings.CHUNK_INTERVAL, 180 * DAY_S))
    store.write_batch(fixtures.lineitem_samples(spark, sf_dir), 0)
    return store


def lineitem_store(spark: SparkSession, sf_dir: str) -> MetricStore:
    return _once("lineitem", spark, sf_dir, lambda: write_lineitem_store(spark, sf_dir))


def cents(value: Column) -> Column:
    return F.round(value * 100).cast("bigint")


def ids_text(ids: Column | str) -> Column:
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), ",")


def micros(time: Column | str) -> Column:
    return F.unix_micros(time)


# -- dimensions ----------------------------------------------------------------------------


@query
def metric_dictionary(spark, sf_dir):
    """UPS5, PRJ7"""
    return plain_events(spark, sf_dir).catalog.metric.select("metric_id", "metric_name", "table_name")


@query
def metric_get_or_create(spark, sf_dir):
    """UPS5: names of orders and of events against the metrics of events."""
    metric = plain_events(spark, sf_dir).catalog.metric
    names = fixtures.table(spark, sf_dir, "events").select(F.col("event_type").alias("metric_name")).union(
        fixtures.table(spark, sf_dir, "orders").select("o_orderpriority")
    )
    return get_or_create_metrics(metric, names)


@query
def label_dictionary(spark, sf_dir):
    """UPS1, AGG10"""
    return plain_events(spark, sf_dir).catalog.label


@query
def label_keys(spark, sf_dir):
    """UPS3, PRJ7"""
    return plain_events(spark, sf_dir).catalog.label_key


@query
def label_positions(spark, sf_dir):
    """UPS2, AGG1"""
    return plain_events(spark, sf_dir).catalog.label_key_position


@query
def label_dictionary_grown(spark, sf_dir):
    """UPS1, SET1: the dictionary after a second batch keeps the ids of the first."""
    samples = staged(fixtures.event_samples(spark, sf_dir))
    half = F.col("time") < F.timestamp_seconds(F.lit(1705363200))
    first = ingest(samples.filter(half), Catalog.empty(spark)).catalog
    return ingest(samples.filter(~half), first).catalog.label


@query
def encode_series(spark, sf_dir):
    """UPS4, UPS6, J1, J2, J3"""
    series = plain_events(spark, sf_dir).catalog.series
    return series.select("series_id", "metric_id", ids_text("label_ids").alias("label_ids"))


@query
def decode_series(spark, sf_dir):
    """AGG3, AGG4, J4"""
    c = plain_events(spark, sf_dir).catalog
    keys, vals = encode.key_value_arrays(F.col("labels"))
    return encode.decode_series(c.series, c.label).select(
        "series_id",
        F.array_join(keys, ",").alias("keys"),
        F.array_join(vals, ",").alias("vals"),
        F.to_json(encode.label_map(F.col("labels"))).alias("js"),
    )


@query
def canonical_series_labels(spark, sf_dir):
    """PRJ1, PRJ2, PRJ3: static, target and own labels; the sample's own label wins."""
    s = fixtures.event_samples(spark, sf_dir)
    static = parse_static_labels("env=prod,zone=none")
    target = labels_of([("pod", F.concat(F.lit("p"), (F.col("event_id") % 4).cast("string"))), ("instance", F.lit(None))])
    merged = with_static_labels(F.col("labels"), static, target)
    canonical = canonical_labels(F.col("name"), merged)
    return s.select("event_id", labels_text(canonical).alias("labels"))


@query
def series_keys_distinct(spark, sf_dir):
    """PRJ3: label sets, and how many hashes they share."""
    lists = fixtures.event_samples(spark, sf_dir).groupBy("name", "labels").agg(F.count(F.lit(1)).alias("n"))
    keyed = lists.withColumn("canonical", canonical_labels(F.col("name"), F.col("labels")))
    hashed = keyed.withColumn("set_hash", series_hash(F.col("canonical")))
    sets = hashed.groupBy("name", "canonical", "set_hash").agg(F.sum("n").alias("n"))
    return sets.groupBy("name").agg(
        F.count(F.lit(1)).alias("n_sets"), F.countDistinct("set_hash").alias("n_hashes"), F.sum("n").alias("n_samples")
    )


@query
def labels_from_json(spark, sf_dir):
    """SRC10"""
    e = fixtures.table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit('{"__name__":"'), "event_type", F.lit('","user":'), F.col("user_id").cast("string"), F.lit(',"on":true}')).alias("js"),
    )
    return label_json.from_labels_json(e, "js").select("event_id", "name", labels_text(F.col("labels")).alias("labels"))


# -- facts and views -----------------------------------------------------------------------


@query
def stored_samples(spark, sf_dir):
    """J15, SNK1, AGG11, CFG5: every stored fact with its series and chunk."""
    store = event_store(spark, sf_dir)
    c = store.catalog()
    named = encode.decode_series(c.series, c.label).select("series_id", labels_text(F.col("labels")).alias("labels"))
    return store.facts().join(named, "series_id", "left").select(
        "labels", micros("time").alias("us"), cents(F.col("value")).alias("cents"), "sample_kind", "chunk_start", "chunk_end"
    )


@query
def metric_view_error(spark, sf_dir):
    """PRJ4, J5, PRJ6"""
    p = plain_events(spark, sf_dir)
    v = views.metric_view(p.catalog, p.facts, "error")
    return v.select(
        micros("time").alias("us"), cents(F.col("value")).alias("cents"), "series_id", ids_text("labels").alias("labels"),
        "k_id", "tier_id", "user_id", "zone_id",
    )


@query
def series_view_error(spark, sf_dir):
    """PRJ5, J7"""
    v = views.series_view(plain_events(spark, sf_dir).catalog, "error")
    return v.select("series_id", ids_text("labels").alias("labels"), "k", "tier", "user", "zone")


@query
def time_range_scan(spark, sf_dir):
    """H4: a time range pruned by chunk, per metric."""
    store = event_store(spark, sf_dir)
    rows = settings.in_time_range(store.facts(), 1704758400 + 3600, 1705536000 - 1800)
    return rows.join(store.catalog().metric, "metric_id").groupBy("metric_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("value"))).alias("cents")
    )


@query
def chunk_list(spark, sf_dir):
    """CFG5, J16"""
    store = event_store(spark, sf_dir)
    return (
        store.summary().groupBy("metric_id", "chunk_start", "chunk_end").agg(F.sum("n").alias("n"))
        .join(store.catalog().metric.select("metric_id", "metric_name"), "metric_id")
        .select("metric_name", "chunk_start", "chunk_end", "n")
    )


@query
def backfill_chunks(spark, sf_dir):
    """RET4: late copies of the purchases merged into their chunks."""
    store = write_event_store(spark, sf_dir)
    purchase = selectors.metric_id(store.catalog(), "purchase")
    late = store.facts().filter(F.col("metric_id") == purchase).withColumn("value", -F.col("value"))
    store.rewrite_chunks(late, 1)
    return (
        store.facts().join(store.catalog().metric.select("metric_id", "metric_name"), "metric_id")
        .groupBy("metric_name", "chunk_start").agg(F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("value"))).alias("cents"))
    )


def _stored_sums(store: MetricStore) -> DataFrame:
    named = store.facts().join(store.catalog().metric.select("metric_id", "metric_name"), "metric_id")
    return named.groupBy("metric_name").agg(F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("value"))).alias("cents"))


@query
def store_reused_batch_id(spark, sf_dir):
    """SNK1, AGG11: two writers use one batch id, and one of them writes it twice"""
    store = MetricStore(spark, fresh_folder(spark, "two-writers"))
    store.replace_catalog(settings.set_default(store.catalog(), settings.CHUNK_INTERVAL, 10 * DAY_S))
    events = fixtures.event_samples(spark, sf_dir)
    for writer, odd in (("a", 0), ("b", 1), ("a", 0)):
        store.write_batch(events.where(F.col("event_id") % 2 == odd), 0, writer)
    return _stored_sums(store)


@query
def store_replay_after_rewrite(spark, sf_dir):
    """SNK1, RET4: chunks are merged with late rows, then their batch is written again"""
    store = MetricStore(spark, fresh_folder(spark, "replays"))
    store.replace_catalog(settings.set_default(store.catalog(), settings.CHUNK_INTERVAL, 10 * DAY_S))
    events = fixtures.event_samples(spark, sf_dir)
    store.write_batch(events, 0)
    late = durable(store.facts().where(F.col("metric_id") == selectors.metric_id(store.catalog(), "view")), "late")
    store.rewrite_chunks(late, 0, "late")
    store.write_batch(events, 0)
    return _stored_sums(store)


def _small_store(spark: SparkSession, name: str) -> MetricStore:
    store = MetricStore(spark, fresh_folder(spark, name))
    store.replace_catalog(settings.set_default(store.catalog(), settings.CHUNK_INTERVAL, 10 * DAY_S))
    return store


@query
def compact_chunks(spark, sf_dir):
    """SNK1, RET4: chunks of three batches merged; sums of facts and summary, and parts per chunk"""
    store = _small_store(spark, "merged-store")
    events = fixtures.event_samples(spark, sf_dir)
    for n in range(3):
        store.write_batch(events.where(F.col("event_id") % 3 == n), n)
    store.compact_chunks(1706400000)
    chunk = ["metric_id", "chunk_start", "chunk_end"]
    facts = store.facts().groupBy(*chunk).agg(F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("value"))).alias("cents"))
    summed = store.summary().groupBy(*chunk).agg(
        F.sum("n").alias("n_summary"), F.countDistinct("series_id").alias("n_series"), F.count(F.lit(1)).alias("n_rows")
    )
    parts = store.log.frame(store.log.state().of("samples")).groupBy(*chunk).agg(F.count(F.lit(1)).alias("parts"))
    named = facts.join(summed, chunk).join(parts, chunk).join(store.catalog().metric.select("metric_id", "metric_name"), "metric_id")
    merged = F.col("n_rows") == F.col("n_series")
    return named.select("metric_name", "chunk_start", "n", "cents", "n_summary", "n_series", "parts", merged.alias("summary_merged"))


@query
def bucketed_dimensions(spark, sf_dir):
    """UPS1, UPS4, J15: dimensions merged into buckets, then a batch of known and new labels"""
    store = _small_store(spark, "bucketed-store")
    events = fixtures.event_samples(spark, sf_dir)
    early = F.col("time") < F.timestamp_seconds(F.lit(1705363200))
    store.write_batch(events.where(early), 0)
    store.merge_parts(least=1)
    store.write_batch(events.where(~early), 1)
    c = store.catalog()
    named = encode.decode_series(c.series, c.label).select("series_id", labels_text(F.col("labels")).alias("labels"))
    use = store.table("label_use").groupBy("id").agg(F.sum("n").alias("n")).join(c.label, "id")
    facts = store.facts().groupBy("series_id").agg(F.count(F.lit(1)).alias("n")).join(named, "series_id").select("labels", "n")
    return facts.unionByName(use.select(F.concat("key", F.lit(":"), "value").alias("labels"), "n"))


@query
def batch_outcomes(spark, sf_dir):
    """SNK1: what each batch stored in each metric, as the commits tell"""
    store = _small_store(spark, "outcomes")
    events = fixtures.event_samples(spark, sf_dir)
    for n in range(2):
        store.write_batch(events.where(F.col("event_id") % 2 == n), n)
    return store.outcomes().join(store.catalog().metric, "metric_id").select("batch_id", "metric_name", F.col("rows").alias("n"))


@query
def store_refuses_other_batch(spark, sf_dir):
    """SNK1: a batch, the same rows in another order, and other rows under its identity"""
    store = _small_store(spark, "refusals")
    events = fixtures.event_samples(spark, sf_dir)
    even = events.where(F.col("event_id") % 2 == 0)
    store.write_batch(even, 0)
    store.write_batch(even.repartition(5, "event_id"), 0)
    refused = 0
    try:
        store.write_batch(events.where(F.col("event_id") % 2 == 1), 0)
    except OtherBatch:
        refused = 1
    return _stored_sums(store).withColumn("refused", F.lit(refused))


@query
def drop_metric_chunks(spark, sf_dir):
    """RET2: one metric of a store before a given time; what is left, by facts and by summary"""
    store = write_event_store(spark, sf_dir)
    store.drop_metric_chunks("view", 1705363200)
    c = store.catalog()
    facts = store.facts().groupBy("metric_id").agg(F.count(F.lit(1)).alias("n_left"))
    summed = store.summary().groupBy("metric_id").agg(F.sum("n").alias("n_summary"))
    series = c.series.groupBy("metric_id").agg(F.count(F.lit(1)).alias("series_left"))
    named = c.metric.join(facts, "metric_id").join(summed, "metric_id").join(series, "metric_id")
    return named.select("metric_name", "n_left", "n_summary", "series_left")


@query
def target_made_anew(spark, sf_dir):
    """FLT1: dumps before and after all targets were deleted and made again at one time"""
    store = _small_store(spark, "made-anew")
    docs = fixtures.event_dumps(spark, sf_dir)
    early = F.col("scrape_ts") < MADE_S
    ingest_dumps(store, docs.where(early), 0)
    made = docs.select(F.col("target").alias("name"), F.array().cast(LABELS).alias("labels"), F.lit(MADE_S).cast("bigint").alias("last_scrape"))
    ingest_dumps(store, docs.where(~early), 1, targets=made.distinct())
    named = store.facts().join(store.catalog().metric, "metric_id")
    return named.select("metric_name", F.unix_millis("time").alias("ms"), cents(F.col("value")).alias("cents"))


# -- selectors -----------------------------------------------------------------------------


def _selected(p: Ingested, series: DataFrame, metric: str | None = None) -> DataFrame:
    """Chosen series by their labels, with count and sum of their facts; of one ``metric``,
    only its partitions are read."""
    named = encode.decode_series(series, p.catalog.label).select("series_id", labels_text(F.col("labels")).alias("labels"))
    only = None if metric is None else selectors.metric_id(p.catalog, metric)
    sums = selectors.facts_of(p.facts, series, only).groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("value"))).alias("cents")
    )
    return named.join(sums, "series_id").select("labels", "n", "cents")


def _selector_query(name: str, metric: str, *matchers: selectors.Matcher, indexed: bool = False) -> None:
    def run(spark, sf_dir):
        p = stored_events(spark, sf_dir)
        if indexed:
            index = event_store(spark, sf_dir).table("postings")
            return _selected(p, postings.select_series(p.catalog, index, metric, *matchers), metric)
        return _selected(p, selectors.select_series(p.catalog, metric, *matchers), metric)

    run.__name__ = name
    query(run)


_selector_query("sel_eq", "error", selectors.equal("tier", "gold"))
_selector_query("sel_neq", "error", selectors.not_equal("zone", "z1"))
_selector_query("sel_re", "error", selectors.matches("k", "^[1-3]"))
_selector_query("sel_nre", "error", selectors.not_matches("user", "5$"))
_selector_query(
    "sel_and", "click", selectors.matches("user", "1"), selectors.not_equal("tier", "gold"), selectors.not_matches("k", "[02468]$"),
    indexed=True,
)
_selector_query("sel_neq_indexed", "error", selectors.not_equal("zone", "z1"), indexed=True)
_selector_query("sel_absent_positive", "view", selectors.equal("zone", ""))
_selector_query("sel_absent_negative", "view", selectors.not_equal("nokey", "x"), selectors.not_equal("zone", "nosuch"))


@query
def sel_contains(spark, sf_dir):
    """FLT4, J6, by the postings of the labels"""
    p = stored_events(spark, sf_dir)
    pairs = {"__name__": "x", "tier": "gold", "zone": "z1"}
    index = event_store(spark, sf_dir).table("postings")
    return _selected(p, postings.select_containing(p.catalog, index, "click", pairs), "click")


@query
def sel_across_metrics(spark, sf_dir):
    """FLT2, FLT3 over all metrics at once"""
    p = stored_events(spark, sf_dir)
    chosen = selectors.select_across_metrics(p.catalog, selectors.matches("k", "^1"), selectors.not_equal("tier", "gold"))
    return _selected(p, chosen)


@query
def sel_literal_ids(spark, sf_dir):
    """AGG5, FLT2, FLT3: selectors over the series of all metrics, counted per metric."""
    p = plain_events(spark, sf_dir)
    out = []
    for m in (selectors.equal("tier", "gold"), selectors.not_equal("zone", "z1"), selectors.equal("tier", "none")):
        chosen = selectors.select_across_metrics(p.catalog, m)
        out.append(chosen.groupBy("metric_id").agg(F.count(F.lit(1)).alias("n")).withColumn("matcher", F.lit(f"{m.key}:{m.pattern}")))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def sel_equal_json(spark, sf_dir):
    """FLT7 and its exact form, for sets with and without inner gaps"""
    p = coarse_events(spark, sf_dir)
    out = None
    for name, pairs in (
        ("all", {"lvl": "1", "tier": "gold", "zone": "z1"}),
        ("first", {"lvl": "1"}),
        ("gap", {"tier": "gold"}),
        ("none", {"__name__": "error"}),
        ("unknown", {"lvl": "9"}),
    ):
        for form, select in (("eq", selectors.select_equal), ("exact", selectors.select_equal_exact)):
            only = selectors.metric_id(p.catalog, "error")
            rows = selectors.facts_of(p.facts, select(p.catalog, "error", pairs), only)
            one = rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("series_id").alias("n_series"))
            one = one.select(F.lit(name).alias("pairs"), F.lit(form).alias("form"), "n", "n_series")
            out = one if out is None else out.unionByName(one)
    return out


@query
def eq_pairs(spark, sf_dir):
    """FLT5 and its exact form: the labels of each event against those of the next."""
    p = coarse_events(spark, sf_dir)
    ids = p.facts.join(p.catalog.series, ["metric_id", "series_id"]).select("event_id", "label_ids")
    a = ids.select((F.col("event_id") + 1).alias("event_id"), F.col("label_ids").alias("a"))
    both = a.join(ids.withColumnRenamed("label_ids", "b"), "event_id")
    return both.select("event_id", matching.eq(F.col("a"), F.col("b")).alias("eq"), matching.eq_exact(F.col("a"), F.col("b")).alias("eq_exact"))


@query
def matcher_pairs(spark, sf_dir):
    """J6, FLT4, FLT6, FLT7, AGG7: the labels of each event against a label map of the next."""
    p = coarse_events(spark, sf_dir)
    ids = p.facts.join(p.catalog.series, ["metric_id", "series_id"]).select("event_id", "label_ids")
    own = fixtures.coarse_samples(spark, sf_dir).select(
        (F.col("event_id") - 1).alias("event_id"),
        F.map_from_entries(
            F.concat("labels", labels_of([("__name__", F.col("name")), ("more", F.when(F.col("event_id") % 10 == 0, "?"))]))
        ).alias("pairs"),
    )
    rows = selectors.matcher_arrays(own, "event_id", "pairs", p.catalog.label).join(ids, "event_id")
    labels, matcher = F.col("label_ids"), F.col("matcher")
    return rows.select(
        "event_id",
        matching.count_keys(F.col("pairs")).alias("n_keys"),
        matching.contains(labels, matcher).alias("contains"),
        matching.match_positive(labels, matcher).alias("any_of"),
        matching.eq_matcher(labels, matcher).alias("eq_matcher"),
        matching.eq_map(labels, F.col("pairs"), matcher).alias("eq_map"),
    )


@query
def group_by_label(spark, sf_dir):
    """AGG13, FLT14"""
    p = stored_events(spark, sf_dir)
    chosen = selectors.select_series(p.catalog, "error", selectors.matches("k", "^[1-3]"))
    facts = p.facts.filter(F.col("metric_id") == selectors.metric_id(p.catalog, "error"))
    g = views.group_by_label(p.catalog, facts, chosen, "error", "tier", cents(F.col("value")))
    return g.select("tier", "n", F.col("sum").alias("cents"), F.col("min").alias("least"), F.col("max").alias("greatest"))


@query
def group_by_user(spark, sf_dir):
    """AGG13 over a stored metric, by a key with many values"""
    store = event_store(spark, sf_dir)
    c = store.catalog()
    facts = store.facts().filter(F.col("metric_id") == selectors.metric_id(c, "view"))
    g = views.group_by_label(c, facts, selectors.metric_series(c, "view"), "view", "user", cents(F.col("value")))
    return g.select("user", "n", F.col("sum").alias("cents"))


# -- SQL -----------------------------------------------------------------------------------


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A query over the views and functions of the event store."""
    sql.register(event_store(spark, sf_dir))
    return spark.sql(text)


@query
def sql_group_by_value(spark, sf_dir):
    """SQL: a metric's view grouped by the text of a label, and by a series view's column

    Facts shrink to a row per series and then per id before ids are named, so no fact goes
    through the look-up of ``val``, where an id that many share is one task's."""
    return _sql(
        spark, sf_dir,
        """
        WITH per_series AS (
          SELECT series_id, tier_id, count(*) AS n, sum(CAST(round(value * 100) AS BIGINT)) AS cents
          FROM error GROUP BY series_id, tier_id),
        per_id AS (
          SELECT p.tier_id, s.zone, sum(p.n) AS n, sum(p.cents) AS cents
          FROM per_series p JOIN error_series s USING (series_id) GROUP BY p.tier_id, s.zone)
        SELECT val(tier_id) AS tier, zone, sum(n) AS n, sum(cents) AS cents FROM per_id GROUP BY val(tier_id), zone""",
    )


@query
def sql_labels_of_series(spark, sf_dir):
    """SQL: keys, values and JSON of the series of a metric"""
    return _sql(
        spark, sf_dir,
        """
        SELECT labels, array_join(keys, ',') AS keys, array_join(vals, ',') AS vals,
          label_key_position_of('click', 'user') AS user_pos, label_key_position_of('click', 'none') AS no_pos
        FROM labels_of_series('click')""",
    )


@query
def sql_matchers(spark, sf_dir):
    """SQL: matchers as sets of label ids, one of them negative, on a metric's facts"""
    return _sql(
        spark, sf_dir,
        """
        SELECT val(user_id) AS user, count(*) AS n, count_if(label_eq(labels, labels)) AS same,
          count_if(label_contains(labels, array(tier_id))) AS gold, count_if(is_stale_marker('value')) AS stale
        FROM view
        WHERE k_id IN (SELECT id FROM matcher('k', '=~', '^1')) AND coalesce(zone_id, 0) NOT IN (SELECT id FROM matcher('zone', '=', 'z1'))
        GROUP BY val(user_id)""",
    )


# -- overviews and settings ----------------------------------------------------------------


@query
def metric_info(spark, sf_dir):
    """AGG8, J12, J13"""
    store = event_store(spark, sf_dir)
    c = settings.set_metric(store.catalog(), settings.RETENTION_PERIOD, "click", DAY_S)
    return info.metric_info(c, store.summary()).select(
        "metric_name", "table_name", "retention_s", "chunk_interval_s", F.array_join("label_keys", ",").alias("label_keys"),
        "n_samples", "n_series", micros("first_time").alias("first_us"), micros("last_time").alias("last_us"), "n_chunks",
    )


@query
def label_info(spark, sf_dir):
    """AGG9"""
    return info.label_info(plain_events(spark, sf_dir).catalog)


@query
def label_values_of_series(spark, sf_dir):
    """J4, J7: how many series hold each label"""
    c = plain_events(spark, sf_dir).catalog
    ids = c.series.select(F.explode("label_ids").alias("id"))
    return ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).join(c.label, "id").select("key", "value", "n")


@query
def effective_settings(spark, sf_dir):
    """CFG1-4, SET2"""
    c = plain_events(spark, sf_dir).catalog
    c = settings.set_default(c, settings.RETENTION_PERIOD, 10 * DAY_S)
    c = settings.set_metric(c, settings.RETENTION_PERIOD, "view", 20 * DAY_S)
    c = settings.set_metric(c, settings.CHUNK_INTERVAL, "click", 3600)
    c = settings.set_metric(c, settings.CHUNK_INTERVAL, "error", 60)
    c = settings.reset_metric(c, settings.CHUNK_INTERVAL, "error")
    c = settings.set_metric(c, settings.RETENTION_PERIOD, "made_by_setting", 7)
    names = c.metric.select("metric_name").union(
        fixtures.table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    )
    return settings.effective_settings_of(c, names)


@query
def name_unique(spark, sf_dir):
    """PRJ6, PRJ7"""
    c = fixtures.table(spark, sf_dir, "customer")
    n = F.col("c_custkey")
    full = F.concat("c_name", F.repeat(F.lit("x"), (n % 70).cast("int")))
    reserved = F.when(n % 7 == 0, "time").when(n % 7 == 1, "labels").otherwise("timely")
    return c.select(
        "c_custkey",
        naming.unique_name(full, n.cast("string")).alias("table_name"),
        naming.value_column_name(full, n).alias("value_column"),
        naming.id_column_name(full, n).alias("id_column"),
        naming.view_key(reserved).alias("view_key"),
    )


# -- retention -----------------------------------------------------------------------------


def _retention_catalog(store: MetricStore) -> Catalog:
    c = settings.set_default(store.catalog(), settings.RETENTION_PERIOD, 10 * DAY_S)
    return settings.set_metric(c, settings.RETENTION_PERIOD, "view", 29 * DAY_S)


def _dropped(spark, sf_dir, scope: str = "all") -> tuple[retention.Retention, Catalog]:
    """What a retention run would drop. The settings of the stored catalog are left as they are."""
    store = event_store(spark, sf_dir)
    c = _retention_catalog(store)
    run = lambda: store.retention(retention.period_limits(c, NOW_S), scope)
    return _once(f"retention-{scope}", spark, sf_dir, run), c


@query
def expired_metrics(spark, sf_dir):
    """RET1, J11"""
    store = event_store(spark, sf_dir)
    c = settings.set_metric(_retention_catalog(store), settings.RETENTION_PERIOD, "click", 60 * DAY_S)
    return retention.expired_metrics(c, store.summary(), NOW_S).select("metric_name")


@query
def retention_cutoffs(spark, sf_dir):
    """RET2, TOP1"""
    r, c = _dropped(spark, sf_dir)
    return r.cutoffs.join(c.metric, "metric_id").select("metric_name", "cutoff_s")


@query
def retention_series(spark, sf_dir):
    """RET2, RET3, SET4, J8, J10"""
    r, c = _dropped(spark, sf_dir)
    named = encode.decode_series(r.dropped_series, c.label)
    return named.select(labels_text(F.col("labels")).alias("labels"))


@query
def retention_labels(spark, sf_dir):
    """RET2, J9, AGG10: labels no series of any metric uses any more"""
    r, _ = _dropped(spark, sf_dir)
    return r.dropped_labels.select("key", "value")


@query
def retention_labels_by_metric(spark, sf_dir):
    """RET2 with labels judged by the metric that lost a series"""
    r, _ = _dropped(spark, sf_dir, "metric")
    return r.dropped_labels.select("key", "value")


@query
def retention_labels_expired(spark, sf_dir):
    """RET2, J9 where the labels of old days go: one label per day and one per user"""
    e = fixtures.table(spark, sf_dir, "events")
    us = micros_of(F.col("ts"))
    day = F.floor(us / (DAY_S * 1000000)).cast("string")
    samples = e.select(
        F.col("event_type").alias("name"), labels_of([("day", day), ("user", F.col("user_id").cast("string"))]).alias("labels"),
        "value", F.timestamp_micros(us).alias("time"),
    )
    p = ingest(staged(samples), Catalog.empty(spark))
    c = settings.set_default(p.catalog, settings.RETENTION_PERIOD, 10 * DAY_S)
    summary, use = retention.chunk_summary(p.facts), retention.label_use(c.series)
    return retention.drop_chunks(c, summary, use, NOW_S).dropped_labels.select("key", "value")


@query
def retention_facts(spark, sf_dir):
    """RET3: what is left per metric, and what is dropped"""
    r, c = _dropped(spark, sf_dir)
    left = r.remaining(event_store(spark, sf_dir).facts()).groupBy("metric_id").agg(F.count(F.lit(1)).alias("n_left"), F.countDistinct("chunk_start").alias("chunks_left"))
    gone = r.dropped_chunks.groupBy("metric_id").agg(F.count(F.lit(1)).alias("chunks_dropped"))
    series = r.catalog.series.groupBy("metric_id").agg(F.count(F.lit(1)).alias("series_left"))
    out = c.metric.join(left, "metric_id", "left").join(gone, "metric_id", "left").join(series, "metric_id", "left")
    return out.select("metric_name", "n_left", "chunks_left", "chunks_dropped", "series_left")


@query
def retention_applied(spark, sf_dir):
    """RET3 on a store: chunks removed, dimensions rewritten, then read back"""
    store = write_event_store(spark, sf_dir)
    store.replace_catalog(_retention_catalog(store))
    store.apply_retention(NOW_S)
    c = store.catalog()
    facts = store.facts().groupBy("metric_id").agg(F.count(F.lit(1)).alias("n_left"))
    series = c.series.groupBy("metric_id").agg(F.count(F.lit(1)).alias("series_left"))
    return c.metric.join(facts, "metric_id").join(series, "metric_id").select("metric_name", "n_left", "series_left")


# -- exposition ----------------------------------------------------------------------------


def _label(labels: Column, key: str) -> Column:
    return F.try_element_at(F.transform(F.filter(labels, lambda p: p["key"] == key), lambda p: p["value"]), F.lit(1))


@query
def parse_round_trip(spark, sf_dir):
    """SRC1, SRC2, SRC4-8, J14: events rendered as dumps and parsed back"""
    parsed = exposition.parse_exposition(fixtures.event_dumps(spark, sf_dir))
    return parsed.select(
        "doc_id", "target", "scrape_ts", "line", "name", "series_type",
        _label(F.col("labels"), "user").alias("user"), _label(F.col("labels"), "props").alias("props"),
        cents(F.col("value")).alias("cents"), "own_ts", F.unix_millis("time").alias("ms"),
    )


def _file_samples(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "target", "scrape_ts", "line", "name", "series_type",
        _label(F.col("labels"), "user").alias("user"), _label(F.col("labels"), "props").alias("props"),
        cents(F.col("value")).alias("cents"), "own_ts", F.unix_millis("time").alias("ms"),
    )


def _by_small_splits(spark: SparkSession) -> SparkSession:
    """A session beside this one whose files are cut more often."""
    fine = spark.newSession()
    fine.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
    fine.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return fine


@query
def read_dump_files(spark, sf_dir):
    """SRC1, SRC2, SRC4-8: dumps written as files and read again, a row for each"""
    folder = fresh_folder(spark, "dump-files")
    fixtures.write_dump_files(spark, sf_dir, folder)
    return _file_samples(exposition.parse_exposition(exposition.read_exposition(spark, folder)))


@query
def read_split_dumps(spark, sf_dir):
    """SRC1, SRC2, SRC4-8, J14: dumps written as files and read by line splits, with help texts,
    types and line numbers carried over them"""
    folder = fresh_folder(spark, "dump-files")
    fixtures.write_dump_files(spark, sf_dir, folder)
    parsed = split_dumps.parse_lines(split_dumps.read_lines(_by_small_splits(spark), folder))
    return spark.read.schema(parsed.schema).parquet(durable_path(parsed, "parsed")).transform(_file_samples)


@query
def ingest_split_dumps(spark, sf_dir):
    """SRC1, SNK1, SNK3, FLT1: dumps read by line splits into a store, with the age rule"""
    folder = fresh_folder(spark, "dump-files")
    fixtures.write_dump_files(spark, sf_dir, folder)
    root = fresh_folder(spark, "split-store")
    store = MetricStore(_by_small_splits(spark), root)
    store.replace_catalog(settings.set_default(store.catalog(), settings.CHUNK_INTERVAL, 30 * DAY_S))
    ingest_dumps(store, split_dumps.read_lines(store.spark, folder), 0, {"env": "prod"})
    store = MetricStore(spark, root)
    c = store.catalog()
    named = encode.decode_series(c.series, c.label).select("series_id", labels_text(F.col("labels")).alias("labels"))
    return store.facts().join(named, "series_id", "left").select(
        "labels", F.unix_millis("time").alias("ms"), cents(F.col("value")).alias("cents")
    )


@query
def parse_families(spark, sf_dir):
    """SRC3-8: typed counters, summaries and histograms, late and changed declarations"""
    parsed = exposition.parse_exposition(fixtures.family_dumps(spark, sf_dir), timestamp_unit="s")
    return parsed.select(
        "doc_id", "line", "name", "series_type", labels_text(F.col("labels")).alias("labels"),
        cents(F.col("value")).alias("cents"), "own_ts",
    )


@query
def parse_families_float(spark, sf_dir):
    """SRC6 with counters read as floats"""
    parsed = exposition.parse_exposition(fixtures.family_dumps(spark, sf_dir), counter_mode="float")
    return parsed.groupBy("name", "series_type").agg(F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("value"))).alias("cents"))


@query
def parse_rejects(spark, sf_dir):
    """SRC8"""
    return exposition.rejected_lines(fixtures.family_dumps(spark, sf_dir)).select("doc_id", "line", "text")


@query
def type_registry(spark, sf_dir):
    """SRC3"""
    return exposition.metric_types(fixtures.family_dumps(spark, sf_dir))


@query
def family_names(spark, sf_dir):
    """SRC9"""
    return exposition.families(fixtures.family_dumps(spark, sf_dir), "summary", "histogram").drop("line")


@query
def label_escapes(spark, sf_dir):
    """SRC2, SRC5: whole documents as label values, escaped and parsed back"""
    parsed = exposition.parse_exposition(fixtures.text_dumps(spark, sf_dir))
    return parsed.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), _label(F.col("labels"), "lang").alias("lang"),
        F.md5(_label(F.col("labels"), "text")).alias("text_md5"), F.col("value").cast("bigint").alias("n_chars"),
    )


@query
def age_filter(spark, sf_dir):
    """FLT1"""
    docs = fixtures.event_dumps(spark, sf_dir)
    samples = durable(exposition.parse_exposition(docs), "parsed")
    limits = age.bookmarks(docs.select("doc_id", "target", "scrape_ts"))
    kept = age.age_filter(samples, limits)
    return kept.select("doc_id", "target", "scrape_ts", "name", "own_ts")


@query
def age_filter_untimed(spark, sf_dir):
    """FLT1 where only every other sample has a time of its own"""
    docs = fixtures.event_dumps(spark, sf_dir)
    mixed = F.regexp_replace("body", "(?m)^(.*[02468]) [0-9]+$", "$1")
    samples = durable(exposition.parse_exposition(docs.withColumn("body", mixed)), "parsed")
    kept = age.age_filter(samples, age.bookmarks(docs.select("doc_id", "target", "scrape_ts")))
    return kept.groupBy("target", "name").agg(F.count(F.lit(1)).alias("n"), F.count("own_ts").alias("n_timed"))


@query
def remote_write_rows(spark, sf_dir):
    """SNK2: requests, flattened again"""
    samples = exposition.parse_exposition(fixtures.event_dumps(spark, sf_dir))
    target = labels_of([("pod", F.col("target")), ("instance", F.lit(None))])
    rows = remote_write.time_series(samples, parse_static_labels("env=prod"), target)
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("line")) - 1
    series = remote_write.write_requests(rows).select("doc_id", place.alias("at"), F.col("timeseries").alias("ts"))
    text = F.transform("ts.labels", lambda p: F.concat(p["name"], F.lit("="), p["value"]))
    return series.select(
        "doc_id", "at", F.array_join(text, ";").alias("labels"),
        cents(F.col("ts.samples")[0]["value"]).alias("cents"), F.col("ts.samples")[0]["timestamp"].alias("ms"),
    )


@F.arrow_udf(T.DoubleType())
def from_bits(bits: pa.Array) -> pa.Array:
    """Doubles with given bits, which no text of SQL can write."""
    return bits.view(pa.float64())


@query
def stale_markers(spark, sf_dir):
    """FLT12, FLT13: special values made from events, told apart before they are stored"""
    n = F.col("event_id") % 5
    bits = (
        F.when(n == 0, F.lit(values.STALE_BITS)).when(n == 1, F.lit(values.NORMAL_NAN_BITS))
        .when(n == 2, F.lit(0x7FF8000000000000)).when(n == 3, F.lit(0x3FF0000000000000)).otherwise(F.lit(0))
    )
    kind = values.sample_kind(from_bits(bits.cast("bigint")))
    e = fixtures.table(spark, sf_dir, "events").select("event_id", "event_type", kind.alias("kind"))
    return e.select(
        "event_id", "event_type", "kind",
        values.is_stale_marker(F.col("kind")).alias("stale"), values.is_normal_nan(F.col("kind")).alias("normal_nan"),
    )


# -- targets and reports -------------------------------------------------------------------


@query
def discover_targets(spark, sf_dir):
    """SRC11"""
    t = pods.discover_targets(fixtures.pods(spark, sf_dir, OWN_NAMESPACE), OWN_NAMESPACE)
    text = F.transform("labels", lambda p: F.concat(p["key"], F.lit("="), F.coalesce(p["value"], F.lit("?"))))
    return t.select("name", "url", F.array_join(text, ",").alias("labels"))


@query
def fold_targets(spark, sf_dir):
    """STR3"""
    t = targets.fold_targets(fixtures.pod_events(spark, sf_dir), OWN_NAMESPACE)
    return t.select("name", "url", labels_text(F.col("labels")).alias("labels"), "last_scrape")


@query
def refresh_targets(spark, sf_dir):
    """STR4: the targets of the log against a snapshot with the last port of each user"""
    before = targets.fold_targets(fixtures.pod_events(spark, sf_dir), OWN_NAMESPACE)
    log = fixtures.pod_events(spark, sf_dir)
    snapshot = log.groupBy("pod.name").agg(F.max_by("pod", "seq").alias("pod")).select("pod.*")
    now = targets.refresh_targets(before, pods.discover_targets(snapshot, OWN_NAMESPACE), NOW_S)
    return now.select("name", "url", "last_scrape")


@query
def ingest_report(spark, sf_dir):
    """AGG12"""
    r = report.ingest_report(fixtures.scrape_log(spark, sf_dir))
    return r.withColumn("peak_text", format_bytes(F.col("response_bytes_peak") * 100))


# -- line items ----------------------------------------------------------------------------


@query
def lineitem_by_status(spark, sf_dir):
    """SNK1, AGG13 over a larger table"""
    store = lineitem_store(spark, sf_dir)
    c = store.catalog()
    facts = store.facts().filter(F.col("metric_id") == selectors.metric_id(c, "R"))
    chosen = selectors.select_series(c, "R", selectors.not_matches("supplier", "0$"))
    g = views.group_by_label(c, facts, chosen, "R", "status", cents(F.col("value")))
    return g.select("status", "n", F.col("sum").alias("cents"))


@query
def lineitem_by_supplier(spark, sf_dir):
    """AGG13 by a key with many values"""
    store = lineitem_store(spark, sf_dir)
    c = store.catalog()
    facts = store.facts().filter(F.col("metric_id") == selectors.metric_id(c, "N"))
    g = views.group_by_label(c, facts, selectors.metric_series(c, "N"), "N", "supplier", cents(F.col("value")))
    return g.select("supplier", "n", F.col("sum").alias("cents"), F.col("max").alias("greatest"))


@query
def lineitem_ingest(spark, sf_dir):
    """UPS1-6, SNK1: ingest of a table with few labels and many samples per series"""
    store = write_lineitem_store(spark, sf_dir)
    c = store.catalog()
    facts = store.facts().groupBy("metric_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("value"))).alias("cents"), F.countDistinct("series_id").alias("n_series")
    )
    return facts.join(c.metric.select("metric_id", "metric_name"), "metric_id").select("metric_name", "n", "cents", "n_series")


# -- streams -------------------------------------------------------------------------------


def _stream_of(spark: SparkSession, df: DataFrame, name: str, per_batch: int | None = None) -> DataFrame:
    """A table as a stream of files: all in one batch, or a few in each."""
    folder = fresh_folder(spark, name)
    df.write.parquet(folder)
    reader = spark.readStream.schema(df.schema)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).parquet(folder)


@query
def stream_report_events(spark, sf_dir):
    """STR5: counters of batches that arrive in no order of time, summed on reading"""
    shuffled = fixtures.scrape_log(spark, sf_dir).repartition(4, F.xxhash64("target", "scrape_ts"))
    log = _stream_of(spark, shuffled, "scrape-log", per_batch=1)
    folder = fresh_folder(spark, "report")
    stream_report(log, folder, fresh_folder(spark, "report-state")).awaitTermination()
    return read_report(spark, folder)


@query
def stream_ingest_report(spark, sf_dir):
    """STR5, AGG12: dumps ingested as a stream in several batches, the second half under a new
    checkpoint, and the report of that very run"""
    store = MetricStore(spark, fresh_folder(spark, "reported-store"))
    store.replace_catalog(settings.set_default(store.catalog(), settings.CHUNK_INTERVAL, 30 * DAY_S))
    dumps = fixtures.event_dumps(spark, sf_dir)
    first = F.col("scrape_ts") < MADE_S
    for half in (dumps.where(first), dumps.where(~first)):
        stream = _stream_of(spark, half, "dumps")
        stream_ingest(stream, store, fresh_folder(spark, "ingest-state"), interval=None).awaitTermination()
    return store.report()


@query
def ingest_gauges(spark, sf_dir):
    """AGG12: targets of the moment, and series of a store with the bytes of their ids"""
    pods = targets.fold_targets(fixtures.pod_events(spark, sf_dir), OWN_NAMESPACE)
    store = write_lineitem_store(spark, sf_dir)
    gauges = (report.target_gauges(pods), report.series_gauges(store.catalog().series))
    named = [g.select(F.inline(F.array(*(F.struct(F.lit(c).alias("gauge"), F.col(c).alias("value")) for c in g.columns)))) for g in gauges]
    return named[0].unionByName(named[1])


@query
def stream_report_restarted(spark, sf_dir):
    """STR5: the log in two streams, the second with a new checkpoint over the same folder"""
    log = fixtures.scrape_log(spark, sf_dir)
    folder = fresh_folder(spark, "report")
    for odd in (0, 1):
        half = _stream_of(spark, log.where(F.col("scrape_ts") % 2 == odd), "scrape-log")
        stream_report(half, folder, fresh_folder(spark, "report-state")).awaitTermination()
    return read_report(spark, folder)


@query
def stream_targets_restarted(spark, sf_dir):
    """STR3: the later events come with a new checkpoint and meet the targets of the first stream"""
    events = fixtures.pod_events(spark, sf_dir)
    out = fresh_folder(spark, "targets")
    first = F.col("event_time") < F.timestamp_seconds(F.lit(1705363200))
    for half in (events.where(first), events.where(~first)):
        log = _stream_of(spark, half, "pod-events")
        stream_targets(log, out, fresh_folder(spark, "targets-state"), OWN_NAMESPACE).awaitTermination()
    t = target_set(spark, out).latest()
    return t.select("name", "url", labels_text(F.col("labels")).alias("labels"), "last_scrape")


@query
def stream_bookmark_rows(spark, sf_dir):
    """STR2"""
    docs = fixtures.event_dumps(spark, sf_dir).select("doc_id", "target", "scrape_ts")
    log = _stream_of(spark, docs, "scrapes")
    folder = fresh_folder(spark, "bookmarks")
    stream_bookmarks(log, folder, fresh_folder(spark, "bookmarks-state")).awaitTermination()
    return spark.read.parquet(f"{folder}/scrapes").select("doc_id", "target", "scrape_ts", "min_ts")


@query
def stream_target_set(spark, sf_dir):
    """STR3: the events in two batches, by files written in the order of their numbers"""
    events = fixtures.pod_events(spark, sf_dir)
    folder, state = fresh_folder(spark, "pod-events"), fresh_folder(spark, "targets-state")
    out = fresh_folder(spark, "targets")
    first = F.col("event_time") < F.timestamp_seconds(F.lit(1705363200))
    for half in (events.filter(first), events.filter(~first)):
        half.write.mode("append").parquet(folder)
        log = spark.readStream.schema(events.schema).parquet(folder)
        stream_targets(log, out, state, OWN_NAMESPACE).awaitTermination()
    t = target_set(spark, out).latest()
    return t.select("name", "url", labels_text(F.col("labels")).alias("labels"), "last_scrape")


@query
def stream_ingest_dumps(spark, sf_dir):
    """STR1, SNK1, SNK3: dumps streamed into a store, with the age rule"""
    store = MetricStore(spark, fresh_folder(spark, "streamed-store"))
    store.replace_catalog(settings.set_default(store.catalog(), settings.CHUNK_INTERVAL, 30 * DAY_S))
    docs = _stream_of(spark, fixtures.event_dumps(spark, sf_dir), "dumps")
    state = fresh_folder(spark, "ingest-state")
    stream_ingest(docs, store, state, {"env": "prod"}, interval=None).awaitTermination()
    c = store.catalog()
    named = encode.decode_series(c.series, c.label).select("series_id", labels_text(F.col("labels")).alias("labels"))
    return store.facts().join(named, "series_id", "left").select(
        "labels", F.unix_millis("time").alias("ms"), cents(F.col("value")).alias("cents")
    )
