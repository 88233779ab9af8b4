import os

import pytest
from pyspark.sql import functions as F

from metricspark.operators import info, postings, selectors, settings
from metricspark.plans import manifest
from metricspark.plans import store as store_module
from metricspark.plans.ingest import ingest, staged
from metricspark.plans.manifest import ADD, COMMIT, DROP, MANUAL, Manifest
from metricspark.plans.scrapes import ingest_dumps
from metricspark.plans.store import MetricStore, OtherBatch
from metricspark.schema import EXPOSITION_DOC, POD, Catalog
from metricspark.session import durable, fresh_folder, hadoop_path
from metricspark.sources.exposition import read_exposition
from metricspark.streaming.bookmarks import stream_bookmarks
from metricspark.streaming.ingest import stream_ingest
from metricspark.streaming.report import read_report, stream_report
from metricspark.streaming.targets import stream_targets, target_set
from tests.test_operators import decoded, pod, samples

HOUR = 3600


@pytest.fixture
def store(spark):
    return MetricStore(spark, fresh_folder(spark, "test-store"))


def contents(store):
    names = decoded(store.catalog())
    return sorted((r["value"], tuple(sorted(names[r["series_id"]].items()))) for r in store.facts().collect())


def test_batches_are_kept_and_replays_change_nothing(spark, store):
    one = samples(spark, [("m", {"a": "1"}, 1.0, 0), ("m", {"a": "2"}, 2.0, 9 * HOUR)])
    two = samples(spark, [("m", {"a": "1"}, 3.0, 1), ("n", {"b": "1"}, 4.0, 2)])
    assert store.write_batch(one, 0).rows == 2 and store.write_batch(two, 1).rows == 2
    before = contents(store)
    assert [v for v, _ in before] == [1.0, 2.0, 3.0, 4.0]
    assert store.write_batch(two, 1).rows == 2
    assert contents(store) == before
    chunks = {(r["chunk_start"], r["chunk_end"]) for r in store.facts().collect()}
    assert chunks == {(0, 8 * HOUR), (8 * HOUR, 16 * HOUR)}


def test_writers_do_not_share_batch_ids(spark, store):
    store.write_batch(samples(spark, [("m", {"a": "1"}, 1.0, 0)]), 0)
    store.write_batch(samples(spark, [("b", {"c": "2"}, 2.0, 0)]), 0, writer="other")
    assert contents(store) == [(1.0, (("__name__", "m"), ("a", "1"))), (2.0, (("__name__", "b"), ("c", "2")))]
    assert sorted((r["writer"], r["batch_id"], r["written"]) for r in store.commits().collect()) == [("manual", 0, 1), ("other", 0, 1)]


def test_replay_after_a_merge_adds_nothing(spark, store):
    one = samples(spark, [("m", {}, 1.0, 0), ("m", {}, 2.0, 1)])
    store.write_batch(one, 0)
    store.rewrite_chunks(store.facts().where("value = 1").withColumn("value", F.lit(9.0)), 1)
    assert store.write_batch(one, 0).rows == 2
    assert sorted(r["value"] for r in store.facts().collect()) == [1.0, 2.0, 9.0]


def test_rows_of_a_failed_attempt_never_count(spark, store):
    store.stage_batch(samples(spark, [("lost", {}, 5.0, 20 * HOUR)]), store.next_version())
    assert store.facts().count() == 0 and store.catalog().metric.count() == 0
    store.write_batch(samples(spark, [("m", {}, 1.0, 0)]), 0)
    assert contents(store) == [(1.0, (("__name__", "m"),))]


def test_other_rows_under_an_identity_are_refused(spark, store):
    one = samples(spark, [("m", {"a": "1"}, 1.0, 0), ("m", {"a": "2"}, 2.0, 1)])
    assert store.write_batch(one.repartition(4), 0).rows == 2 and store.write_batch(one.coalesce(1), 0).rows == 2
    with pytest.raises(OtherBatch):
        store.write_batch(samples(spark, [("m", {"a": "1"}, 1.0, 0), ("m", {"a": "2"}, 3.0, 1)]), 0)
    docs = spark.createDataFrame([("1", "a", 1000, "ok", "# TYPE m gauge\nm 1 999000\n")], EXPOSITION_DOC)
    ingest_dumps(store, docs, 5)
    with pytest.raises(OtherBatch):
        ingest_dumps(store, docs.withColumn("scrape_ts", F.col("scrape_ts") + 1), 5)
    assert sorted(r["value"] for r in store.facts().collect()) == [1.0, 1.0, 2.0]


def test_rows_by_metric_are_told(spark, store):
    rows = [("m", {}, 1.0, 0), ("m", {}, 2.0, 9 * HOUR), ("n", {"a": "b"}, 3.0, 0)]
    done = store.write_batch(samples(spark, rows), 0)
    assert done.rows == 3 and {r["metric_name"]: r["rows"] for r in done.by_metric.collect()} == {"m": 2, "n": 1}
    assert store.write_batch(samples(spark, rows[:0]), 1).rows == 0
    assert sorted(r["written"] for r in store.commits().collect()) == [0, 3]


def test_readers_keep_their_version_while_chunks_are_merged(spark, store):
    for batch in range(3):
        store.write_batch(samples(spark, [("m", {"a": str(batch)}, float(batch), 0), ("m", {"a": "x"}, 9.0, (batch + 1) * 20 * HOUR)]), batch)
    before, summed = store.facts(), store.summary()
    want = contents(store)
    assert store.compact_chunks(8 * HOUR) == 1 and store.compact_chunks(8 * HOUR) == 0
    assert sorted(r["value"] for r in before.collect()) == sorted(v for v, _ in want) and summed.agg(F.sum("n")).first()[0] == 6
    assert contents(store) == want and store.summary().agg(F.sum("n"), F.count("n")).first()[:] == (6, 6)
    assert len({p["seq"] for p in store.log.state().of("samples").to_pylist() if p["chunk_start"] == 0}) == 1
    assert store.vacuum() >= 3 and contents(store) == want and store.vacuum() == 0


def test_a_chunk_merged_halfway_is_not_seen(spark, store):
    for batch in range(2):
        store.write_batch(samples(spark, [("m", {}, float(batch), 0)]), batch)
    store._write_facts(store.facts(), store.next_version())  # a merge that ends before its version appears
    assert sorted(r["value"] for r in store.facts().collect()) == [0.0, 1.0] == sorted(r["value"] for r in store.facts(1).collect())
    assert store.compact_chunks() == 1 and store.facts().count() == 2 and store.vacuum() >= 2 and store.facts().count() == 2


def test_the_log_stays_short(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "FOLD", 8)
    versions = 60
    log = Manifest(spark, str(tmp_path / "store"))
    for version in range(versions):
        row = {"action": ADD, "part_of": "samples", "seq": version, "metric_id": 1, "chunk_start": 0, "chunk_end": 1, "n": 1, "parts": 1, "level": 0}
        gone = [row | {"action": DROP, "seq": version - 1}] if version else []
        commit = {"action": COMMIT, "writer": "stream", "batch_id": version, "written": version}
        log.publish(version, log.frame([row, *gone, commit, commit | {"writer": MANUAL}] if version % 10 == 0 else [row, *gone, commit]))
    state = log.state()
    assert state.parts["seq"].to_pylist() == [versions - 1]
    assert len(os.listdir(tmp_path / "store" / "log")) <= 18
    assert state.commits.num_rows <= 8 + 1 + 6
    assert log.committed("stream", 3)["written"] == 3 and log.committed("stream", versions - 1) and log.committed(MANUAL, 10)
    assert log.committed("stream", versions) is None and log.committed(MANUAL, 11) is None and log.committed("other", 0) is None
    assert log.history().where("action = 'commit' AND writer = 'stream'").count() == versions
    with pytest.raises(RuntimeError):
        log.publish(versions - 1, log.frame([]))


def test_parts_of_dimensions_are_merged(spark, store, monkeypatch):
    monkeypatch.setattr(store_module, "MERGE", 3)
    for batch in range(5):
        store.write_batch(samples(spark, [("m", {"a": str(batch), "b": "1"}, 1.0, batch)]), batch)
    assert all(len(store.log.state().of(name)) < 5 for name in ("label", "series", "label_use"))
    assert len(contents(store)) == 5 and store.catalog().label.count() == 7
    use = store.table("label_use").groupBy("id").agg(F.sum("n").alias("n")).join(store.catalog().label, "id")
    assert {(r["key"], r["value"]): r["n"] for r in use.collect()} == {("__name__", "m"): 5, ("b", "1"): 5} | {("a", str(i)): 1 for i in range(5)}


def test_a_batch_reads_only_the_buckets_of_its_keys(spark, store):
    store.write_batch(samples(spark, [("m", {"a": str(i)}, 1.0, i) for i in range(300)]), 0)
    store.merge_parts(least=1)
    keys = spark.createDataFrame([("a", "7"), ("a", "new")], "key string, value string")
    found = store.find("label", durable(keys, "keys"))
    assert [(r["key"], r["value"]) for r in found.collect()] == [("a", "7")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    stored = plan[plan.index("BroadcastHashJoin"):plan.index("BroadcastExchange")]
    assert "PartitionFilters" in stored and "bucket" in stored and "Exchange hashpartitioning" not in plan
    some = store._read_parts("label", store.log.state().of("label").to_pylist(), [3, 5]).select(F.input_file_name().alias("f"))
    assert {r["f"].rsplit("/", 2)[1] for r in some.collect()} == {"bucket=3", "bucket=5"}
    before = store.catalog().label.count()
    store.write_batch(samples(spark, [("m", {"a": "7"}, 2.0, 0), ("m", {"a": "new"}, 3.0, 0)]), 1)
    assert store.catalog().label.count() == before + 1 and store.catalog().series.count() == 301
    assert sorted(v for v, labels in contents(store) if dict(labels)["a"] in ("7", "new")) == [1.0, 2.0, 3.0]


def test_ids_are_not_given_again(spark, store):
    store.write_batch(samples(spark, [("m", {"a": "old"}, 1.0, 0), ("m", {"a": "later"}, 2.0, 100 * HOUR)]), 0)
    ids = {r["series_id"] for r in store.catalog().series.collect()}
    assert store.drop_metric_chunks("m", 50 * HOUR) == 1
    store.write_batch(samples(spark, [("m", {"a": "new"}, 3.0, 100 * HOUR)]), 1)
    assert len({r["series_id"] for r in store.catalog().series.collect()} - ids) == 1
    c, index = store.catalog(), store.table("postings")
    assert selected_values(store, postings.select_series(c, index, "m", selectors.equal("a", "new"))) == [3.0]
    assert selected_values(store, postings.select_series(c, index, "m")) == [2.0, 3.0]


def selected_values(store, series):
    return sorted(r["value"] for r in selectors.facts_of(store.facts(), series).collect())


def test_retention_and_overview_read_no_facts(spark, store):
    rows = [("m", {"a": "old"}, 1.0, 0), ("m", {"a": "both"}, 2.0, 0), ("m", {"a": "both"}, 3.0, 100 * HOUR), ("n", {"a": "old"}, 4.0, 0)]
    store.write_batch(samples(spark, rows), 0)
    path, files = hadoop_path(spark, f"{store.root}/samples")
    files.rename(path, hadoop_path(spark, f"{store.root}/hidden")[0])
    shown = {r["metric_name"]: (r["n_samples"], r["n_series"], r["n_chunks"]) for r in info.metric_info(store.catalog(), store.summary()).collect()}
    assert shown == {"m": (3, 2, 2), "n": (1, 1, 1)}
    assert store.drop_metric_chunks("m", 50 * HOUR) == 1 and store.drop_metric_chunks("m", 50 * HOUR) == 0
    assert {r["value"] for r in store.catalog().label.collect()} == {"m", "n", "both", "old"}
    assert store.drop_metric_chunks("n", 50 * HOUR) == 1
    assert {r["value"] for r in store.catalog().label.collect()} == {"m", "both"}
    files.rename(hadoop_path(spark, f"{store.root}/hidden")[0], path)
    assert [r["value"] for r in store.facts().collect()] == [3.0]


def test_a_new_checkpoint_under_an_old_path_is_another_stream(spark, store, tmp_path):
    folder, state = str(tmp_path / "in"), tmp_path / "state"
    for number, part in enumerate((DUMPS[:1], DUMPS[1:2])):
        write_dumps(folder, part)
        docs = read_exposition(spark, folder, streaming=True).where(F.col("scrape_ts") == part[0][1])
        stream_ingest(docs, store, str(state), interval=None).awaitTermination()
        state.rename(tmp_path / f"was-{number}")
    assert stored(store) == WANT[:3] and len({r["writer"] for r in store.commits().collect()}) == 2


def test_a_target_deleted_and_made_again_starts_anew(spark, store):
    dump = lambda at, body: spark.createDataFrame([(str(at), "a", at, "ok", body)], EXPOSITION_DOC)
    kinds = "name string, labels array<struct<key:string,value:string>>, last_scrape long"
    ingest_dumps(store, dump(900, "# TYPE m gauge\nm 1 890000\n"), 0)
    made = spark.createDataFrame([("a", [], 950)], kinds)
    ingest_dumps(store, dump(1000, "# TYPE m gauge\nm 2 920000\nm 3 960000\n"), 1, targets=made)
    ingest_dumps(store, dump(1015, "# TYPE m gauge\nm 4 990000\nm 5 1001000\n"), 2, targets=made)
    assert sorted(r["value"] for r in store.facts().collect()) == [1.0, 3.0, 5.0]


def test_report_before_the_first_batch(spark, tmp_path):
    assert read_report(spark, str(tmp_path / "none")).count() == 0


def test_a_new_target_starts_when_it_was_made(spark, store):
    docs = spark.createDataFrame([("1", "a", 1000, "ok", "# TYPE m gauge\nm 1 800000\nm 2 970000\n")], EXPOSITION_DOC)
    kinds = "name string, labels array<struct<key:string,value:string>>, last_scrape long"
    ingest_dumps(store, docs, 0, targets=spark.createDataFrame([("a", [], 950)], kinds))
    assert [r["value"] for r in store.facts().collect()] == [2.0]


def test_an_empty_snapshot_is_the_newest(spark, tmp_path):
    state = target_set(spark, str(tmp_path / "set"))
    full = spark.createDataFrame([("a", "http://a", [], 1)], state.schema)
    state.write(full, "s", 0)
    state.write(full.limit(0), "s", 1)
    assert state.latest().count() == 0 and state.latest(("s", 1)).count() == 1
    state.write(full, "t", 0)
    assert state.latest().count() == 1 and state.latest(("t", 0)).count() == 0


def test_streams_ask_for_the_targets_of_the_moment(spark, store, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    kinds = "name string, labels array<struct<key:string,value:string>>"
    for number, part in enumerate((DUMPS[2:3], DUMPS[3:])):
        write_dumps(folder, part)
        now = spark.createDataFrame([("b", [("round", str(number))])], kinds)
        docs = read_exposition(spark, folder, streaming=True)
        stream_ingest(docs, store, state, targets=lambda: now, interval=None).awaitTermination()
    assert [(v, dict(labels)["round"]) for v, labels in contents(store)] == [(6.0, "0"), (7.0, "1")]


def test_reads_are_pruned_by_metric_and_chunk(spark, store):
    rows = [("m", {"a": "1"}, float(h), h * HOUR) for h in range(0, 100, 2)] + [("n", {}, 0.5, 0)]
    store.write_batch(samples(spark, rows), 0)
    scan = settings.in_time_range(store.facts().filter("metric_id = 1"), 10 * HOUR, 20 * HOUR)
    assert sorted(r["value"] for r in scan.collect()) == [10.0, 12.0, 14.0, 16.0, 18.0]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "metric_id" in filters and "chunk_start" in filters and "chunk_end" in filters
    assert "time" in plan[plan.index("PushedFilters"):]
    assert len(scan.select(F.input_file_name()).distinct().collect()) == 2


def test_old_chunks_keep_the_interval_they_were_written_with(spark, store):
    store.write_batch(samples(spark, [("m", {}, 1.0, HOUR)]), 0)
    store.replace_catalog(settings.set_metric(store.catalog(), settings.CHUNK_INTERVAL, "m", HOUR))
    store.write_batch(samples(spark, [("m", {}, 2.0, 3 * HOUR)]), 1)
    got = {(r["value"], r["chunk_start"], r["chunk_end"]) for r in store.facts().collect()}
    assert got == {(1.0, 0, 8 * HOUR), (2.0, 3 * HOUR, 4 * HOUR)}
    assert settings.in_time_range(store.facts(), 3 * HOUR).count() == 1
    assert settings.in_time_range(store.facts(), HOUR, HOUR + 1).count() == 1


def test_late_facts_are_merged_into_their_chunks(spark, store):
    store.write_batch(samples(spark, [("m", {"a": "1"}, float(i), i * HOUR) for i in range(20)]), 0)
    store.write_batch(samples(spark, [("m", {"a": "1"}, 100.0, 0)]), 1)
    late = store.facts().filter("value = 0").withColumn("value", F.lit(-1.0))
    assert store.rewrite_chunks(late, 2) == 1 and store.rewrite_chunks(late, 2) == 0
    assert sorted(r["value"] for r in store.facts().collect()) == sorted([float(i) for i in range(20)] + [100.0, -1.0])
    assert store.rewrite_chunks(late.limit(0), 3) == 0
    live = [p for p in store.log.state().of("samples").to_pylist() if p["chunk_start"] == 0]
    assert [p["n"] for p in live] == [10] and store.summary().agg(F.sum("n")).first()[0] == 22


def test_retention_on_a_store(spark, store):
    rows = [("m", {"a": "old"}, 1.0, 0), ("m", {"a": "both"}, 2.0, 0), ("m", {"a": "both"}, 3.0, 100 * HOUR)]
    store.write_batch(samples(spark, rows), 0)
    store.replace_catalog(settings.set_default(store.catalog(), settings.RETENTION_PERIOD, 24 * HOUR))
    assert store.apply_retention(110 * HOUR) == 1
    assert contents(store) == [(3.0, (("__name__", "m"), ("a", "both")))]
    assert {r["value"] for r in store.catalog().label.collect()} == {"m", "both"}
    store.write_batch(samples(spark, [("m", {"a": "old"}, 5.0, 101 * HOUR)]), 1)
    assert (5.0, (("__name__", "m"), ("a", "old"))) in contents(store)
    assert store.apply_retention(110 * HOUR) == 0


def write_dumps(folder, dumps):
    for target, scrape_ts, body in dumps:
        path = f"{folder}/target={target}/scrape_ts={scrape_ts}"
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/dump.txt", "w") as f:
            f.write(body)


DUMPS = [
    ("a", 1000, "# TYPE m gauge\nm{x=\"1\"} 1.5 999000\nm 2\nm 3 100000\n"),
    ("a", 1015, "# TYPE m gauge\nm{x=\"1\"} 4 1001000\nm{x=\"1\"} 5 999000\n"),
    ("b", 1000, "# HELP n text \\\nmore\n# TYPE n counter\nn 6\nn 6.5\n"),
    ("b", 1015, "# TYPE n counter\nn 7\n"),
]
WANT = [(1.5, "1"), (2.0, None), (4.0, "1"), (6.0, None), (7.0, None)]


def stored(store):
    return [(v, dict(labels).get("x")) for v, labels in contents(store)]


def test_dumps_in_one_batch(spark, store, tmp_path):
    write_dumps(tmp_path, DUMPS)
    targets = spark.createDataFrame([("a", [("pod", "p"), ("ip", None)])], "name string, labels array<struct<key:string,value:string>>")
    counts = ingest_dumps(store, read_exposition(spark, str(tmp_path)), 0, {"env": "prod"}, targets)
    assert (counts.parsed, counts.written, counts.skipped) == (7, 5, 2)
    assert stored(store) == WANT
    labels = dict(contents(store)[0][1])
    assert labels == {"__name__": "m", "env": "prod", "pod": "p", "x": "1"}
    assert {r["target"]: r["last_scrape"] for r in store.bookmarks().collect()} == {"a": 1015, "b": 1015}


def test_streamed_dumps_equal_the_batch(spark, store, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    for part in (DUMPS[::2], DUMPS[1::2]):
        write_dumps(folder, part)
        docs = read_exposition(spark, folder, streaming=True)
        stream_ingest(docs, store, state, interval=None).awaitTermination()
    assert stored(store) == WANT


def test_write_request_sink(spark, store, tmp_path):
    write_dumps(tmp_path, DUMPS)
    docs = read_exposition(spark, str(tmp_path))
    counts = ingest_dumps(store, docs, 0, [("env", "prod")], sink="write_request")
    assert counts.written == 5
    requests = spark.read.parquet(f"{store.root}/write_requests")
    assert requests.count() == 5 and requests.select("doc_id").distinct().count() == 4
    series = requests.filter(F.col("timeseries.samples")[0]["value"] == 1.5).first()["timeseries"]
    assert [(p["name"], p["value"]) for p in series["labels"]] == [("__name__", "m"), ("env", "prod"), ("x", "1")]
    assert series["samples"][0]["timestamp"] == 999000
    with pytest.raises(ValueError):
        ingest_dumps(store, docs, 1, sink="other")


def test_times_in_seconds(spark, store):
    docs = spark.createDataFrame([("1", "a", 1000, "ok", "# TYPE m gauge\nm 1 999\nm 2 5\n")], EXPOSITION_DOC)
    assert ingest_dumps(store, docs, 0, timestamp_unit="s").written == 1
    assert store.facts().select(F.unix_seconds("time")).first()[0] == 999


def test_streamed_bookmarks(spark, tmp_path):
    folder = str(tmp_path / "in")
    for part in ([("1", "a", 1000), ("2", "a", 1015)], [("3", "a", 1030), ("4", "b", 1030)]):
        rows = spark.createDataFrame(part, "doc_id string, target string, scrape_ts bigint")
        rows.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        stream_bookmarks(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out" / "scrapes"))
    assert {r["doc_id"]: r["min_ts"] for r in got.collect()} == {"1": 700, "2": 1000, "3": 1015, "4": 730}


def test_streamed_targets(spark, tmp_path):
    folder = str(tmp_path / "in")
    on, other = {"own/scrape": "1"}, {"own/scrape": "1", "own/port": "81"}
    batches = (
        [(1, "ADDED", pod("a", on)), (2, "ADDED", pod("b", on)), (3, "ADDED", pod("c", on))],
        [(4, "MODIFIED", pod("a", on)), (5, "MODIFIED", pod("b", other)), (6, "DELETED", pod("c", on))],
    )
    for part in batches:
        rows = spark.createDataFrame(part, f"seq bigint, type string, pod {POD.simpleString()}")
        rows = rows.withColumn("event_time", F.timestamp_seconds(F.col("seq") * 100))
        rows.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        stream_targets(stream, str(tmp_path / "out"), str(tmp_path / "state"), "own").awaitTermination()
    got = {r["name"]: (r["url"][-10:], r["last_scrape"]) for r in target_set(spark, str(tmp_path / "out")).latest().collect()}
    assert got == {"a": ("80/metrics", 100), "b": ("81/metrics", 500)}


def test_streamed_report(spark, tmp_path):
    rows = spark.createDataFrame(
        [(10, "ok", 3, 1, 0, 2, 100), (299, "failed", 0, 0, 0, 0, None), (300, "timeout", 0, 0, 0, 0, None), (310, "refused", 0, 0, 0, 0, None)],
        "scrape_ts bigint, outcome string, samples bigint, skipped bigint, failed bigint, new_series bigint, response_bytes bigint",
    )
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows.write.parquet(folder)
    stream_report(spark.readStream.schema(rows.schema).parquet(folder), out, str(tmp_path / "state")).awaitTermination()
    got = {r["interval_start"]: (r["scrapes"], r["scrape_errors"], r["scrape_timeouts"], r["scrape_refused"], r["writes"]) for r in read_report(spark, out).collect()}
    assert got == {0: (1, 1, 0, 0, 3), 300: (0, 0, 1, 1, 0)}


def test_report_is_committed_with_its_batch(spark, tmp_path):
    store = MetricStore(spark, str(tmp_path / "store"))
    assert store.report().collect() == []
    body = "# TYPE a gauge\na{k=\"1\"} 1 90000\na{k=\"2\"} 2 250000\nnot a sample"
    rows = [("d1", "t1", 300, body), ("d2", "t2", 620, "# TYPE a gauge\na{k=\"2\"} 3")]
    dumps = spark.createDataFrame(rows, "doc_id string, target string, scrape_ts long, body string")
    for _ in range(2):  # the second run is skipped and counts nothing
        ingest_dumps(store, dumps, 0)
    # A second batch: its samples of before the first scrape of the target are too old.
    late = spark.createDataFrame([("d3", "t1", 301, body)], dumps.schema)
    ingest_dumps(store, late, 1)
    got = {r["interval_start"]: r.asDict() for r in store.report().collect()}
    names = ("scrapes", "writes", "write_skips", "new_series", "response_bytes", "response_bytes_peak")
    assert {k: tuple(v[n] for n in names) for k, v in got.items()} == {
        300: (2, 2, 2, 0, 2 * len(body), len(body)), 600: (1, 1, 0, 2, len(rows[1][3]), len(rows[1][3]))}
    assert store.facts().count() == sum(v["writes"] for v in got.values())
    empty = dumps.limit(0)
    ingest_dumps(store, empty, 2)
    assert store.report().count() == 2


def test_a_batch_computes_its_samples_once(spark, store):
    made = spark.sparkContext.accumulator(0)

    def seen(value: float) -> float:
        made.add(1)
        return value

    rows = samples(spark, [("m", {"a": str(i)}, float(i), i) for i in range(20)])
    once = F.udf(seen, "double").asNondeterministic()
    store.write_batch(rows.withColumn("value", once("value")), 0)
    assert made.value == 20 and len(contents(store)) == 20


def test_samples_of_few_series_are_not_shuffled(spark):
    rows = samples(spark, [("m", {"a": str(i % 3), "b": "1"}, float(i), i) for i in range(50)])
    made = ingest(staged(rows), Catalog.empty(spark))
    plan = made.facts._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and made.facts.count() == 50


def test_labels_keep_their_order_and_gaps(spark, store):
    """A key twice, the name's own key, and unset slots take the longer ways."""
    store.write_batch(samples(spark, [("m", {"a": "1", "c": "3"}, 1.0, 0), ("m", {"b": "2"}, 2.0, 0), ("m", {"c": "3", "a": "1"}, 3.0, 0)]), 0)
    assert sorted(r["label_ids"].count(0) for r in store.catalog().series.collect()) == [1, 1]
    assert sorted((v, sorted(l)) for v, l in contents(store)) == [
        (1.0, [("__name__", "m"), ("a", "1"), ("c", "3")]), (2.0, [("__name__", "m"), ("b", "2")]),
        (3.0, [("__name__", "m"), ("a", "1"), ("c", "3")]),
    ]
