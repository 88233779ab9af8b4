"""Samples, dumps, pods and logs derived from the provided tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricspark.functions.labels import labels_from_map, labels_of
from metricspark.functions.text import escape_label_value, instant, micros_of
from metricspark.sources.label_json import labels_map

EVENTS_PER_DUMP = 50
EVENTS_PER_FILE = 20_000
FILE_SCRAPED_AFTER_S = 86400
SCRAPE_INTERVAL_S = 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """The rows dealt over all tasks by a key, at every size: a file of one row group is one task
    otherwise, however much its rows are multiplied afterwards."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _text(value: Column) -> Column:
    return value.cast("string")


def event_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as samples of five metrics.

    Labels: ``user``, ``k`` from the JSON properties, ``tier`` on even users only (an inner
    gap) and ``zone`` on every third user only (the last position).
    """
    e = dealt(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props"), "event_id")
    own = labels_of(
        [
            ("user", _text(F.col("user_id"))),
            ("tier", F.when(F.col("user_id") % 2 == 0, "gold")),
            ("zone", F.when(F.col("user_id") % 3 == 0, "z1")),
        ]
    )
    return e.select(
        F.col("event_type").alias("name"),
        F.concat(labels_from_map(labels_map(F.col("props"))), own).alias("labels"),
        "value",
        instant(F.col("ts")).alias("time"),
        "event_id",
    )


def coarse_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as samples of few series, whose arrays have gaps and differ in length."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("name"),
        labels_of(
            [
                ("lvl", F.when(F.col("event_id") % 7 != 0, _text(F.col("event_id") % 3))),
                ("tier", F.when(F.col("user_id") % 2 == 0, "gold")),
                ("zone", F.when(F.col("user_id") % 3 == 0, "z1")),
            ]
        ).alias("labels"),
        "value",
        instant(F.col("ts")).alias("time"),
        "event_id",
    )


def lineitem_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as samples: metric by return flag, labels line status and supplier."""
    columns = ("l_orderkey", "l_returnflag", "l_linestatus", "l_suppkey", "l_extendedprice", "l_shipdate")
    li = dealt(table(spark, sf_dir, "lineitem").select(*columns), "l_orderkey")
    return li.select(
        F.col("l_returnflag").alias("name"),
        labels_of([("status", F.col("l_linestatus")), ("supplier", _text(F.col("l_suppkey")))]).alias("labels"),
        F.col("l_extendedprice").alias("value"),
        instant(F.col("l_shipdate")).alias("time"),
    )


def _event_line() -> Column:
    return F.concat(
        F.col("event_type"), F.lit('{user="'), _text(F.col("user_id")), F.lit('",props="'),
        escape_label_value(F.col("props")), F.lit('"} '), _text(F.col("value")), F.lit(" "),
        _text(F.floor(micros_of(F.col("ts")) / 1000)),
    )


def event_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as scrape dumps of a fixed number of events each.

    ``doc_id`` counts the dumps, ``target`` is one of ten, and ``scrape_ts`` the end of the
    15 s bucket of the dump's last event. Each kind of event is declared once, at its first
    line; the values are floats, so the metrics are gauges.
    """
    e = table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / EVENTS_PER_DUMP).alias("n"),
        "event_id",
        "event_type",
        micros_of(F.col("ts")).alias("us"),
        _event_line().alias("text"),
    )
    lines = F.sort_array(F.collect_list(F.struct("event_type", "event_id", "text")))
    types = F.array_sort(F.collect_set("event_type"))
    section = lambda t: F.concat(
        F.array(F.concat(F.lit("# TYPE "), t, F.lit(" gauge"))),
        F.transform(F.filter("lines", lambda x: x["event_type"] == t), lambda x: x["text"]),
    )
    last_s = F.ceil(F.col("last_us") / (SCRAPE_INTERVAL_S * 1000000)) * SCRAPE_INTERVAL_S
    # A dump holds EVENTS_PER_DUMP events, so its group is bounded.
    return (
        e.groupBy("n")
        .agg(lines.alias("lines"), types.alias("types"), F.max("us").alias("last_us"))
        .select(
            _text(F.col("n")).alias("doc_id"),
            F.concat(F.lit("t"), _text(F.col("n") % 10)).alias("target"),
            last_s.cast("bigint").alias("scrape_ts"),
            F.lit("ok").alias("outcome"),
            F.array_join(F.flatten(F.transform("types", section)), "\n").alias("body"),
        )
    )


def write_dump_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Events written as dumps of many lines, one file each, under ``target=…/scrape_ts=…/``.

    A file begins with a help text over two lines, the second of which looks like a sample, and
    declares its kinds of events once; its lines are in order of event_id. Each has a target of
    its own, scraped a day after its first event.
    """
    columns = ("event_id", "event_type", "user_id", "value", "props", "ts")
    e = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / EVENTS_PER_FILE).alias("n"), *columns)
    lines = e.select("n", F.col("event_id").alias("at"), _event_line().alias("value"))
    declared = F.transform(
        F.array_sort(F.collect_set("event_type")), lambda t: F.concat(F.lit("# TYPE "), t, F.lit(" gauge"))
    )
    opening = F.concat(F.lit("# HELP click Events of a kind, \\\nclick 1\n"), F.array_join(declared, "\n"))
    first_s = F.min(F.floor(micros_of(F.col("ts")) / 1000000))
    files = e.groupBy("n").agg(
        opening.alias("value"),
        F.concat(F.lit("t"), _text(F.col("n"))).alias("target"),
        (first_s + FILE_SCRAPED_AFTER_S).cast("bigint").alias("scrape_ts"),
    )
    heads = files.select("target", "scrape_ts", F.lit(-1).cast("bigint").alias("at"), "value")
    rows = lines.join(files.drop("value"), "n").select("target", "scrape_ts", "at", "value").unionByName(heads)
    # A file holds EVENTS_PER_FILE events, so its group is bounded.
    whole = rows.repartition("target", "scrape_ts").sortWithinPartitions("target", "scrape_ts", "at").drop("at")
    whole.write.partitionBy("target", "scrape_ts").text(folder)


def text_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dump per document: its whole text, escaped, as a label value."""
    d = dealt(table(spark, sf_dir, "documents").select("doc_id", "lang", "text", "n_chars"), "doc_id")
    return d.select(
        _text(F.col("doc_id")).alias("doc_id"),
        F.lit("docs").alias("target"),
        F.lit(0).cast("bigint").alias("scrape_ts"),
        F.lit("ok").alias("outcome"),
        F.concat(
            F.lit("# HELP doc_chars Length of a text, \\\nover two lines.\n# TYPE doc_chars counter\n"),
            F.lit('doc_chars{lang="'), escape_label_value(F.col("lang")), F.lit('",text="'),
            escape_label_value(F.col("text")), F.lit('"} '), _text(F.col("n_chars")),
        ).alias("body"),
    )


def family_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dump per order: a counter, a summary, a histogram, an undeclared and a bad line."""
    o = dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderkey")
    key = _text(F.col("o_orderkey"))
    total = _text(F.col("o_totalprice"))
    late = F.when(F.col("o_orderkey") % 3 == 0, "gauge").otherwise("counter")
    lines = F.array(
        F.lit("early 1"),
        F.lit("# TYPE orders_total counter"),
        F.concat(F.lit('orders_total{status="'), F.col("o_orderstatus"), F.lit('"} '), key),
        F.concat(F.lit("orders_total "), total),
        F.lit("# TYPE price summary"),
        F.concat(F.lit('price{quantile="0.5"} '), total),
        F.concat(F.lit("price_sum "), total),
        F.concat(F.lit("price_count "), key),
        F.lit("# TYPE wait histogram"),
        F.concat(F.lit('wait_bucket{le="+Inf",} '), key, F.lit("   17")),
        F.concat(F.lit("wait "), key),
        F.concat(F.lit("wait_sum "), total),
        F.lit("# TYPE early untyped"),
        F.lit("early 2"),
        F.concat(F.lit("# TYPE early "), late),
        F.concat(F.lit("early "), total),
        F.concat(F.lit("price_count "), key),
    )
    return o.select(
        key.alias("doc_id"),
        F.lit("orders").alias("target"),
        F.lit(0).cast("bigint").alias("scrape_ts"),
        F.lit("ok").alias("outcome"),
        F.array_join(lines, "\n").alias("body"),
    )


def scrape_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of scrapes: one per event, with outcome and response size."""
    e = table(spark, sf_dir, "events")
    outcome = (
        F.when(F.col("event_type") == "error", "failed")
        .when(F.col("event_id") % 11 == 0, "timeout")
        .when(F.col("event_id") % 13 == 0, "refused")
        .otherwise("ok")
    )
    ok = outcome == "ok"
    return e.select(
        F.concat(F.lit("t"), _text(F.col("user_id") % 10)).alias("target"),
        F.floor(micros_of(F.col("ts")) / 1000000).alias("scrape_ts"),
        outcome.alias("outcome"),
        F.when(ok, F.col("user_id") * 100).alias("response_bytes"),
        F.when(ok, F.col("event_id") % 5 + 1).otherwise(0).alias("samples"),
        F.when(ok, F.col("event_id") % 2).otherwise(0).alias("skipped"),
        F.lit(0).cast("bigint").alias("failed"),
        F.when(ok, F.col("event_id") % 3).otherwise(0).alias("new_series"),
    )


def pods(spark: SparkSession, sf_dir: str, own: str = "own.example") -> DataFrame:
    """Suppliers as pods with assorted annotations."""
    s = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    key = F.col("s_suppkey")
    notes = map_of(
        {
            "prometheus.io/scrape": F.when(key % 4 != 0, "false"),
            f"{own}/scrape": F.when(key % 6 == 0, "true"),
            f"{own}/port": F.when(key % 5 == 0, "none"),
            "prometheus.io/port": F.when(key % 3 == 0, _text(key + 9000)),
            "prometheus.io/path": F.when(key % 2 == 0, F.concat(F.lit("//m/"), _text(key))),
            f"{own}/path": F.when(key % 7 == 0, "stats"),
            f"{own}/metadata": F.when(key % 9 == 0, "namespace,,other,pod"),
        }
    )
    return s.select(
        F.col("s_name").alias("name"),
        F.col("n_name").alias("namespace"),
        F.when(key % 10 != 0, F.concat(F.lit("10.0."), _text(F.floor(key / 256)), F.lit("."), _text(key % 256))).alias("pod_ip"),
        F.when(key % 8 != 0, F.concat(F.lit("192.168.0."), _text(key % 256))).alias("host_ip"),
        F.when(key % 12 == 5, "Pending").otherwise("Running").alias("phase"),
        notes.alias("annotations"),
    )


def pod_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of changes to pods, one pod per user.

    The port of a pod changes now and then, at times it is no target, and it is deleted
    now and then.
    """
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    kind = (
        F.when(eid % 17 == 0, "DELETED")
        .when(eid % 5 == 0, "BOOKMARK")
        .when(eid % 2 == 0, "ADDED")
        .otherwise("MODIFIED")
    )
    scrape = F.when(
        eid % 13 != 0,
        F.create_map(
            F.lit("prometheus.io/scrape"), F.lit("true"),
            F.lit("prometheus.io/port"), _text(9000 + F.floor(eid / 1000) % 3),
        ),
    ).otherwise(F.create_map().cast("map<string,string>"))
    return e.select(
        eid.alias("seq"),
        instant(F.col("ts")).alias("event_time"),
        kind.alias("type"),
        F.struct(
            F.concat(F.lit("pod-"), _text(F.col("user_id"))).alias("name"),
            F.lit("ns").alias("namespace"),
            F.concat(F.lit("10.1.0."), _text(F.col("user_id") % 256)).alias("pod_ip"),
            F.lit("192.168.1.1").alias("host_ip"),
            F.lit("Running").alias("phase"),
            scrape.alias("annotations"),
        ).alias("pod"),
    )


def map_of(values: dict[str, Column]) -> Column:
    """A map of the values that are not null."""
    return F.map_from_entries(labels_of(list(values.items())))
