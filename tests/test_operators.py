"""Operators against brute force on small inputs, hot keys included."""

import random

import pytest
from pyspark.sql import functions as F

from metricspark.functions.labels import labels_from_map, labels_of
from metricspark.operators import age, dictionary, encode, postings, remote_write, retention, selectors, settings, targets, views
from metricspark.operators.ids import assign_ids
from metricspark.operators.ordered import previous_in_order
from metricspark.plans import ingest as ingest_module
from metricspark.plans.ingest import ingest
from metricspark.schema import FACT, LABEL, METRIC, POD, SERIES, Catalog
from metricspark.sources import pods


def samples(spark, rows):
    """Rows of (name, labels, value, second)."""
    df = spark.createDataFrame(rows, "name string, m map<string,string>, value double, s bigint")
    return df.select("name", labels_from_map(F.col("m")).alias("labels"), "value", F.timestamp_seconds("s").alias("time"))


def decoded(catalog):
    rows = encode.decode_series(catalog.series, catalog.label).collect()
    return {r["series_id"]: {p["key"]: p["value"] for p in r["labels"]} for r in rows}


def test_ids_are_dense_sorted_and_continue(spark):
    words = [f"w{i:05d}" for i in range(5000)]
    random.Random(1).shuffle(words)
    rows = spark.createDataFrame([(w,) for w in words], "key string").repartition(16)
    got = [(r["id"], r["key"]) for r in assign_ids(rows, ["key"], "id").orderBy("id").collect()]
    assert got == list(zip(range(1, 5001), sorted(words)))
    after = spark.createDataFrame([(41,), (7,)], "id int")
    assert assign_ids(rows, ["key"], "id", after=after).agg(F.min("id"), F.max("id")).first()[:] == (42, 5041)
    assert assign_ids(rows.limit(0), ["key"], "id").count() == 0


def test_second_batch_keeps_ids_and_positions(spark):
    first = ingest(samples(spark, [("m", {"a": "1", "c": "x"}, 1.0, 0), ("n", {}, 1.0, 0)]), Catalog.empty(spark))
    c1 = first.catalog
    second = ingest(
        samples(spark, [("m", {"b": "2", "c": "x"}, 2.0, 1), ("m", {"a": "1", "c": "x"}, 3.0, 2), ("k", {"a": "1"}, 4.0, 3)]), c1
    )
    c2 = second.catalog
    old = {(r["key"], r["value"]): r["id"] for r in c1.label.collect()}
    new = {(r["key"], r["value"]): r["id"] for r in c2.label.collect()}
    assert old.items() <= new.items() and sorted(new.values()) == list(range(1, len(new) + 1))
    positions = {(r["metric_name"], r["key"]): r["pos"] for r in c2.label_key_position.collect()}
    assert positions == {
        ("m", "__name__"): 1, ("m", "a"): 2, ("m", "c"): 3, ("m", "b"): 4, ("n", "__name__"): 1, ("k", "__name__"): 1, ("k", "a"): 2,
    }
    arrays = {tuple(r["label_ids"]) for r in c2.series.collect()}
    of = lambda k, v: new[(k, v)]
    assert (of("__name__", "m"), 0, of("c", "x"), of("b", "2")) in arrays
    assert (of("__name__", "n"),) in arrays and second.added["series"].count() == 2
    assert second.facts.count() == 3 and second.facts.filter("value = 3.0").first()["series_id"] in {
        r["series_id"] for r in c1.series.collect()
    }
    replay = ingest(samples(spark, [("m", {"b": "2", "c": "x"}, 2.0, 1)]), c2)
    assert all(rows.count() == 0 for rows in replay.added.values())


@pytest.mark.parametrize("both", [True, False])
def test_label_lists_that_share_a_key_keep_their_series(spark, monkeypatch, both):
    """One hash or both are the same for all lists of metric m."""
    whole = ingest_module.set_hashes

    def some(name, labels):
        first, other = whole(name, labels)
        same = F.when(name == "m", F.lit(1).cast("bigint")).otherwise(first)
        return same, F.when(name == "m", F.lit(7).cast("bigint")).otherwise(other) if both else other

    monkeypatch.setattr(ingest_module, "set_hashes", some)
    rows = [("m", {"a": str(i % 5)}, float(i % 5), i) for i in range(20)] + [("n", {"b": "1"}, 9.0, 0)]
    made = ingest(samples(spark, rows), Catalog.empty(spark))
    names = decoded(made.catalog)
    got = sorted((r["value"], names[r["series_id"]].get("a")) for r in made.facts.collect())
    assert got == sorted([(float(i % 5), str(i % 5)) for i in range(20)] + [(9.0, None)], key=lambda t: (t[0], t[1] or ""))


def test_lists_in_another_order_or_with_duplicates_are_one_series(spark):
    df = spark.createDataFrame(
        [("m", [("a", "1"), ("b", "2")]), ("m", [("b", "2"), ("a", "1")]), ("m", [("b", "9"), ("a", "1"), ("b", "2")])],
        "name string, labels array<struct<key:string,value:string>>",
    ).select("name", "labels", F.lit(1.0).alias("value"), F.timestamp_seconds(F.lit(0)).alias("time"))
    out = ingest(df, Catalog.empty(spark))
    assert out.catalog.series.count() == 1 and out.facts.count() == 3
    assert list(decoded(out.catalog).values()) == [{"__name__": "m", "a": "1", "b": "2"}]


def test_a_hot_series_with_a_third_of_all_samples(spark):
    rng = random.Random(3)
    rows = [("hot", {"a": "1"}, float(i), i) for i in range(3000)]
    rows += [(f"m{rng.randint(0, 9)}", {"a": str(rng.randint(0, 50))}, float(i), i) for i in range(6000)]
    out = ingest(samples(spark, rows), Catalog.empty(spark))
    names = decoded(out.catalog)
    got = sorted((r["value"], names[r["series_id"]]["__name__"], names[r["series_id"]]["a"]) for r in out.facts.collect())
    assert got == sorted((v, n, m["a"]) for n, m, v, _ in rows)


def test_selectors_on_absent_keys_and_metrics(spark):
    rows = [("m", {"a": "1"}, 1.0, 0), ("m", {"b": "2"}, 2.0, 0), ("n", {"z": "1"}, 3.0, 0)]
    c = ingest(samples(spark, rows), Catalog.empty(spark)).catalog
    count = lambda *m: selectors.select_series(c, "m", *m).count()
    assert count() == 2
    assert count(selectors.equal("z", "1")) == 0 and count(selectors.not_equal("z", "1")) == 2
    assert count(selectors.equal("a", "")) == 0 and count(selectors.not_equal("a", "1")) == 1
    assert count(selectors.matches("a", "")) == 1 and count(selectors.not_matches("a", "")) == 1
    assert selectors.select_series(c, "nosuch").count() == 0
    assert selectors.select_across_metrics(c, selectors.not_equal("z", "1")).count() == 2
    assert selectors.select_across_metrics(c, selectors.equal("z", "1")).count() == 1
    assert selectors.select_containing(c, "m", {}).count() == 2
    assert selectors.matches("a|b", "x").ids(c.label).count() == 0


def test_views_with_reserved_names_and_orphans(spark):
    rows = [("m", {"time": "t1", "a": "1"}, 1.0, 0), ("m", {"a": "2"}, 2.0, 0)]
    out = ingest(samples(spark, rows), Catalog.empty(spark))
    c = out.catalog
    orphan = out.facts.limit(1).withColumn("series_id", F.lit(99).cast("bigint"))
    v = views.metric_view(c, out.facts.unionByName(orphan), "m")
    assert v.columns == ["time", "value", "series_id", "labels", "a_id", "label_time_id"]
    got = {r["series_id"]: (r["labels"], r["a_id"], r["label_time_id"]) for r in v.collect()}
    assert got[99] == (None, None, None) and [g[2] for s, g in got.items() if s != 99].count(None) == 1
    s = views.series_view(c, "m")
    assert s.columns == ["series_id", "labels", "a", "label_time"]
    assert sorted((r["a"], r["label_time"]) for r in s.collect() if r["a"] == "1") == [("1", "t1")]
    sums = views.aggregate_by_label(c, out.facts, selectors.metric_series(c, "m"), "m", "time", F.sum("value").alias("v"))
    assert {(r["time"], r["v"]) for r in sums.collect()} == {("t1", 1.0), (None, 2.0)}
    by_absent = views.group_by_label(c, out.facts, selectors.metric_series(c, "m"), "m", "nokey")
    assert [(r["nokey"], r["n"], r["avg"]) for r in by_absent.collect()] == [(None, 2, 1.5)]


def test_label_look_ups(spark):
    c = ingest(samples(spark, [("m", {"a": "1"}, 1.0, 0)]), Catalog.empty(spark)).catalog
    assert dictionary.label_key_position(c.label_key_position, "m", "a").first()["pos"] == 2
    assert dictionary.label_key_position(c.label_key_position, "m", "b").count() == 0
    assert dictionary.metric_by_name(c.metric, "m").first()["table_name"] == "m"
    assert dictionary.metric_by_name(c.metric, "x").count() == 0


@pytest.mark.parametrize("bucket", [1, 7, 10_000])
def test_previous_row_with_a_hot_key(spark, bucket):
    rng = random.Random(bucket)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 20)}", rng.randint(0, 500), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "key string, t bigint, id bigint")
    got = {r["id"]: (r["prev_t"], r["prev_id"]) for r in previous_in_order(df, "key", ["t", "id"], ["t", "id"], bucket).collect()}
    want, last = {}, {}
    for key, t, i in sorted(rows, key=lambda r: (r[1], r[2])):
        want[i] = last.get(key, (None, None))
        last[key] = (t, i)
    assert got == want


def test_bookmarks(spark):
    scrapes = spark.createDataFrame(
        [("1", "a", 1000), ("2", "a", 1015), ("3", "a", 5000), ("4", "b", 1000), ("5", "c", 1000)],
        "doc_id string, target string, scrape_ts bigint",
    )
    initial = spark.createDataFrame([("b", 995), ("d", 1)], "target string, last_scrape bigint")
    got = {r["doc_id"]: r["min_ts"] for r in age.bookmarks(scrapes, initial).collect()}
    assert got == {"1": 700, "2": 1000, "3": 4700, "4": 995, "5": 700}
    last = {r["target"]: r["last_scrape"] for r in age.last_scrapes(scrapes, initial).collect()}
    assert last == {"a": 5000, "b": 1000, "c": 1000, "d": 1}
    rows = [("1", None, 1000, "a"), ("1", 699, 1000, "b"), ("1", 700, 1000, "c"), ("2", 999, 1015, "d"), ("2", 1000, 1015, "e"), ("4", 994, 1000, "f")]
    samples = spark.createDataFrame(rows, "doc_id string, ts bigint, scrape_ts bigint, x string")
    kept = age.age_filter(samples, age.bookmarks(scrapes, initial))
    assert kept.columns == samples.columns and {r["x"] for r in kept.collect()} == {"a", "c", "e"}


def retention_case(spark):
    metric = spark.createDataFrame([(1, "m", "m", True, None, None), (2, "n", "n", True, None, None)], METRIC)
    label = spark.createDataFrame([(i, "k", str(i)) for i in range(1, 9)], LABEL)
    series = spark.createDataFrame(
        [(10, 1, [1, 3, 4]), (11, 1, [1, 0, 5]), (12, 1, [1, 6]), (20, 2, [2, 3]), (21, 2, [2, 7])], SERIES
    )
    c = Catalog.empty(spark).with_(metric=metric, label=label, series=series)
    rows = [(10, 1, 0), (10, 1, 5), (11, 1, 0), (11, 1, 25), (20, 2, 0), (20, 2, 30), (21, 2, 31)]
    facts = spark.createDataFrame(
        [(s, m, t // 10 * 10, t // 10 * 10 + 10, t) for s, m, t in rows],
        "series_id bigint, metric_id int, chunk_start bigint, chunk_end bigint, t bigint",
    )
    facts = facts.select(
        F.timestamp_seconds("t").alias("time"), F.lit(1.0).alias("value"), F.lit("value").alias("sample_kind"),
        "series_id", "metric_id", "chunk_start", "chunk_end",
    )
    facts = facts.select(*[f.name for f in FACT.fields])
    return c, facts, retention.chunk_summary(facts), retention.label_use(series)


def test_retention_of_series_labels_and_chunks(spark):
    c, facts, *tables = retention_case(spark)
    r = retention.drop_metric_chunks(c, *tables, "m", 19)
    assert {x["series_id"] for x in r.dropped_series.collect()} == {10}
    # 3 is still used by another metric; 12 never had samples and is kept with 6.
    assert {x["id"] for x in r.dropped_labels.collect()} == {4}
    assert {x["series_id"] for x in r.catalog.series.collect()} == {11, 12, 20, 21}
    assert [tuple(x) for x in r.dropped_chunks.collect()] == [(1, 0, 10)]
    assert r.remaining(facts).count() == 4
    own = retention.drop_metric_chunks(c, *tables, "m", 19, scope="metric")
    assert {x["id"] for x in own.dropped_labels.collect()} == {3, 4}
    none = retention.drop_metric_chunks(c, *tables, "m", 9)
    assert none.dropped_series.count() == 0 and none.cutoffs.count() == 0 and none.remaining(facts).count() == facts.count()
    assert none.catalog.label.filter("id = 0").count() == 0


def test_retention_of_all_metrics(spark):
    c, facts, *tables = retention_case(spark)
    c = settings.set_default(c, settings.RETENTION_PERIOD, 10)
    c = settings.set_metric(c, settings.RETENTION_PERIOD, "n", 1000)
    assert [x["metric_name"] for x in retention.expired_metrics(c, tables[0], 25).collect()] == ["m"]
    r = retention.drop_chunks(c, *tables, 50)
    assert {x["series_id"] for x in r.dropped_series.collect()} == {10, 11}
    assert {x["id"] for x in r.dropped_labels.collect()} == {1, 4, 5} - {1}
    assert {x["metric_id"] for x in r.remaining(facts).select("metric_id").distinct().collect()} == {2}


def test_settings(spark):
    c = Catalog.empty(spark)
    c = settings.set_metric(c, settings.CHUNK_INTERVAL, "new", 60)
    c = settings.set_metric(c, settings.RETENTION_PERIOD, "new", 5)
    of = lambda c: {r["metric_name"]: (r["chunk_interval_s"], r["retention_s"]) for r in settings.effective_settings(c).collect()}
    assert of(c) == {"new": (60, 5)}
    c = settings.reset_metric(settings.reset_metric(c, settings.CHUNK_INTERVAL, "new"), settings.RETENTION_PERIOD, "new")
    assert of(c) == {"new": (28800, 7776000)}
    assert of(settings.set_default(c, settings.CHUNK_INTERVAL, 9)) == {"new": (9, 7776000)}
    with pytest.raises(ValueError):
        settings.set_default(c, "other", 1)


def pod(name="p", notes=None, ip="1.2.3.4", host="9.9.9.9", phase="Running"):
    return (name, "ns", ip, host, phase, {} if notes is None else notes)


def found(spark, *rows, **kw):
    df = pods.discover_targets(spark.createDataFrame(list(rows), POD), "own", **kw)
    return [(r["name"], r["url"], [(p["key"], p["value"]) for p in r["labels"]]) for r in df.collect()]


def test_discovery(spark):
    on = {"prometheus.io/scrape": "false"}
    usual = [("pod", "p"), ("instance", "9.9.9.9"), ("namespace", "ns")]
    assert found(spark, pod(notes=on)) == [("p", "http://1.2.3.4:80/metrics", usual)]
    assert found(spark, pod(), pod(notes=on, ip=None), pod(name=None, notes=on), pod(notes=on, phase="Failed")) == []
    assert found(spark, pod(notes={"own/scrape": ""}), enabled=["prometheus.io"]) == []
    url = lambda **notes: found(spark, pod(notes={**on, **{k.replace("__", "/").replace("p_io", "prometheus.io"): v for k, v in notes.items()}}))[0][1]
    assert url(p_io__port="9100") == "http://1.2.3.4:9100/metrics"
    assert url(own__port="x", p_io__port="9100") == "http://1.2.3.4:80/metrics"
    assert url(p_io__port="65536") == url(p_io__port="-1") == url(p_io__port="99999999999") == "http://1.2.3.4:80/metrics"
    assert url(p_io__path="//a/b/") == "http://1.2.3.4:80/a/b/" and url(p_io__path="/") == "http://1.2.3.4:80/"
    assert url(own__path="o", p_io__path="s") == "http://1.2.3.4:80/o"
    labels = found(spark, pod(notes={**on, "own/metadata": "namespace,,x,pod,pod"}))[0][2]
    assert labels == [("namespace", "ns"), ("pod", "p"), ("pod", "p")]
    assert found(spark, pod(notes=on, host=None))[0][2][1] == ("instance", None)


def test_target_log_and_snapshots(spark):
    on, other = {"own/scrape": "1"}, {"own/scrape": "1", "own/port": "81"}
    log = [
        (1, "ADDED", pod("a", on)), (2, "MODIFIED", pod("a", on)), (3, "ADDED", pod("b", on)), (4, "MODIFIED", pod("b", other)),
        (5, "ADDED", pod("c", on)), (6, "DELETED", pod("c", on)), (7, "ADDED", pod("d", on)), (8, "MODIFIED", pod("d")),
        (9, "ADDED", pod("e", on)), (10, "DELETED", pod("e", on)), (11, "ADDED", pod("e", on)), (12, "BOOKMARK", pod("a")),
        (13, "ADDED", pod(None, on)), (14, "ERROR", pod("a")),
    ]
    events = spark.createDataFrame(log, f"seq bigint, type string, pod {POD.simpleString()}").withColumn(
        "event_time", F.timestamp_seconds(F.col("seq") * 100)
    )
    got = {r["name"]: (r["url"][-10:], r["last_scrape"]) for r in targets.fold_targets(events, "own").collect()}
    assert got == {"a": ("80/metrics", 100), "b": ("81/metrics", 400), "e": ("80/metrics", 1100)}
    first = targets.fold_targets(events.filter("seq <= 3"), "own")
    both = targets.fold_targets(events.filter("seq > 3"), "own", before=first)
    assert {r["name"]: (r["url"][-10:], r["last_scrape"]) for r in both.collect()} == got
    snapshot = pods.discover_targets(spark.createDataFrame([pod("a", on), pod("b", on), pod("z", on)], POD), "own")
    now = {r["name"]: r["last_scrape"] for r in targets.refresh_targets(both, snapshot, 7777).collect()}
    assert now == {"a": 100, "b": 7777, "z": 7777}


def test_a_dump_of_any_size_is_one_request(spark):
    rows = spark.range(25_000).select(
        F.lit("d").alias("doc_id"), F.col("id").cast("int").alias("line"), F.lit("m").alias("name"),
        F.array().cast("array<struct<key:string,value:string>>").alias("labels"), F.col("id").cast("double").alias("value"),
        F.timestamp_seconds(F.col("id")).alias("time"),
    )
    got = remote_write.write_requests(remote_write.time_series(rows)).orderBy("line").collect()
    assert [r["line"] for r in got] == list(range(25_000)) and {r["doc_id"] for r in got} == {"d"}
    assert got[20_000]["timeseries"]["samples"][0]["value"] == 20_000.0
    assert got[1]["timeseries"]["samples"][0]["timestamp"] == 1000


def test_postings_against_semi_joins(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["m", "n"]), {k: str(rng.randrange(4)) for k in rng.sample(["a", "b", "c"], rng.randint(0, 3))}, 1.0, i) for i in range(400)]
    c = ingest(samples(spark, rows), Catalog.empty(spark)).catalog
    index = postings.postings(c.series)
    cases = [
        [], [selectors.equal("a", "1")], [selectors.equal("a", "1"), selectors.matches("b", "[02]")], [selectors.not_equal("a", "1")],
        [selectors.not_matches("a", "."), selectors.not_equal("zz", "1")], [selectors.equal("zz", "")], [selectors.equal("c", "9")],
        [selectors.matches("a", "[12]"), selectors.not_equal("b", "0"), selectors.not_matches("c", "3")],
    ]
    for metric in ("m", "n", "none"):
        for matchers in cases:
            want = {r["series_id"] for r in selectors.select_series(c, metric, *matchers).collect()}
            assert {r["series_id"] for r in postings.select_series(c, index, metric, *matchers).collect()} == want, matchers
    assert postings.select_containing(c, index, "m", {"__name__": "x"}).count() == c.series.join(c.metric.where("metric_name = 'm'"), "metric_id").count()


def test_label_lists_by_columns_and_by_lists_are_the_same_ids(spark, monkeypatch):
    """Gaps, an unset tail, one label only; positions past the bound are gathered as lists."""
    rows = [("m", {"a": "1", "c": "3"}, 1.0, 0), ("m", {"b": "2"}, 2.0, 1), ("m", {}, 3.0, 2), ("n", {"z": "9"}, 4.0, 3)]
    found = []
    for bound in (encode.COLUMNS, 2):
        monkeypatch.setattr(encode, "COLUMNS", bound)
        made = ingest(samples(spark, rows), Catalog.empty(spark))
        found.append(sorted((r["metric_id"], list(r["label_ids"])) for r in made.catalog.series.collect()))
    assert found[0] == found[1]
    assert sorted(len(ids) for _, ids in found[0]) == [1, 2, 3, 4] and [i for m, ids in found[0] for i in ids].count(0) == 2


def test_new_series_of_one_list_and_of_several_beside_held_ones(spark):
    """A second batch: a held series, a new one in two orders, a new one of one list."""
    schema = "name string, labels array<struct<key:string,value:string>>, value double"
    def of(*rows):
        return spark.createDataFrame([("m", labels, value) for labels, value in rows], schema).withColumn("time", F.timestamp_seconds(F.lit(0)))
    first = ingest(of(([("a", "1")], 1.0)), Catalog.empty(spark))
    second = ingest(
        of(([("a", "1")], 2.0), ([("a", "2"), ("b", "1")], 3.0), ([("b", "1"), ("a", "2")], 4.0), ([("a", "3")], 5.0)), first.catalog
    )
    names = decoded(second.catalog)
    got = {r["value"]: names[r["series_id"]] for r in second.facts.collect()}
    name = {"__name__": "m"}
    assert got == {2.0: name | {"a": "1"}, 3.0: name | {"a": "2", "b": "1"}, 4.0: name | {"a": "2", "b": "1"}, 5.0: name | {"a": "3"}}
    assert second.added["series"].columns == ["series_id", "metric_id", "label_ids"] and second.added["series"].count() == 2


def test_local_rows_and_labels_need_no_python_and_no_higher_order_function(spark):
    empty = Catalog.empty(spark)
    plan = empty.label.join(empty.series.select(F.col("series_id").cast("int").alias("id")), "id")._jdf.queryExecution().toString()
    assert "ExistingRDD" not in plan
    listed = spark.range(3).select(labels_of([("a", F.when(F.col("id") > 0, "x")), ("b", F.lit(None)), ("c", F.col("id").cast("string"))]).alias("l"))
    assert [[tuple(p) for p in r["l"]] for r in listed.orderBy(F.size("l")).collect()][0] == [("c", "0")]
    assert "lambdafunction" not in listed._jdf.queryExecution().toString()


def test_decoded_lists_compile(spark):
    made = ingest(samples(spark, [("m", {"a": "1", "b": "2"}, 1.0, 0)]), Catalog.empty(spark))
    rows = encode.decode_series(made.catalog.series, made.catalog.label)
    js = rows.select(encode.label_map(F.col("labels")).alias("m"))
    assert js.first()["m"] == {"__name__": "m", "a": "1", "b": "2"}
    assert "lambdafunction" not in js._jdf.queryExecution().toString()
