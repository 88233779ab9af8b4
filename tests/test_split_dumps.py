"""Dumps read by line splits against the same dumps read as one row each."""

import os
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from metricspark.plans.scrapes import ingest_dumps
from metricspark.plans.store import MetricStore
from metricspark.sources import exposition, split_dumps

SPLIT = "spark.sql.files.maxPartitionBytes"
COLUMNS = ("doc_id", "target", "scrape_ts", "outcome", "line", "text", "series_type")


@contextmanager
def splits_of(spark, size):
    before = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, str(size))
    try:
        yield
    finally:
        spark.conf.set(SPLIT, before)


def written(folder, *bodies, target="t"):
    for i, body in enumerate(bodies):
        place = folder / f"target={target}" / f"scrape_ts={i}"
        os.makedirs(place)
        (place / "dump.txt").write_bytes(body.encode())
    return str(folder)


def both(spark, path, size):
    """Typed lines of the folder, by whole texts and by splits."""
    whole = exposition.typed_lines(exposition.read_exposition(spark, path)).select(*COLUMNS).collect()
    with splits_of(spark, size):
        split = split_dumps.typed_lines(split_dumps.read_lines(spark, path)).select(*COLUMNS).collect()
    return sorted(map(tuple, whole), key=repr), sorted(map(tuple, split), key=repr)


def made_dump(seed, n):
    draw = random.Random(seed)
    names = ["a", "b", "c", "wait", "size"]

    def line():
        name = draw.choice(names)
        return draw.choices(
            [
                f"{name} {draw.randrange(99)}",
                f'{name}_sum{{k="{draw.choice("xyz")}"}} 1.5 {draw.randrange(10**6)}',
                f"# TYPE {name} {draw.choice(['counter', 'gauge', 'summary', 'histogram', 'untyped'])}",
                f"# HELP {name} text" + draw.choice(["", "\\", "\\"]),
                f"{name} 7\\",
                "# a comment" + draw.choice(["", "\\"]),
                "",
                "   \t",
                "\\",
            ],
            [8, 6, 2, 1, 2, 1, 1, 1, 1],
        )[0]

    return "".join(line() + draw.choice(["\n", "\n", "\r\n"]) for _ in range(n)) + draw.choice(["", "b 3", "# HELP b x\\"])


@pytest.mark.parametrize("size", [40, 200, 1 << 20])
def test_splits_give_the_rows_of_whole_texts(spark, tmp_path, size):
    path = written(tmp_path, *(made_dump(seed, n) for seed, n in enumerate((0, 1, 30, 150, 150))))
    whole, split = both(spark, path, size)
    assert whole and split == whole


def test_a_help_text_over_many_blocks(spark, tmp_path):
    body = "# TYPE a gauge\n# HELP a goes on \\\n" + "a 1 \\\n" * 60 + "a 2\na 3\n"
    path = written(tmp_path, body, body.replace("# HELP", "# NOTE"))
    whole, split = both(spark, path, 30)
    assert split == whole
    assert [text for *_, scrape, _, _, text, _ in split if scrape == 0] == ["a 3"]


def test_a_type_far_before_its_lines(spark, tmp_path):
    body = "# TYPE a gauge\n# TYPE b counter\n" + "".join(f"b {i}\n" for i in range(300)) + "a 1\n# TYPE b gauge\nb 2\n"
    path = written(tmp_path, body)
    whole, split = both(spark, path, 50)
    assert split == whole and sorted(row[4] for row in split) == list(range(302))
    assert {row[6] for row in split} == {"Gauge", "CounterInteger"}


def test_blank_and_empty_files_and_folders_without_a_time(spark, tmp_path):
    path = written(tmp_path, "", "\n\n", "# TYPE a gauge\n", "# TYPE a gauge\na 1")
    extra = tmp_path / "target=t" / "scrape_ts=__HIVE_DEFAULT_PARTITION__"
    os.makedirs(extra)
    (extra / "dump.txt").write_text("# TYPE a gauge\n" + "a 5\n" * 20)
    whole, split = both(spark, path, 20)
    assert len(split) == 21 and split == whole


def test_samples_equal_those_of_whole_texts(spark, tmp_path):
    path = written(tmp_path, *(made_dump(seed, 80) for seed in range(3)))
    whole = exposition.parse_exposition(exposition.read_exposition(spark, path)).select("doc_id", "line", "name", "value", "ts", "time", "sample_kind")
    with splits_of(spark, 64):
        split = split_dumps.parse_lines(split_dumps.read_lines(spark, path)).select(*whole.columns)
        assert sorted(map(repr, split.collect())) == sorted(map(repr, whole.collect()))


def test_a_batch_of_lines_is_ingested_like_whole_texts(spark, tmp_path):
    path = written(tmp_path / "dumps", *(made_dump(seed, 60) for seed in range(2)))
    stores = [MetricStore(spark, str(tmp_path / name)) for name in ("whole", "split")]
    counts = [ingest_dumps(stores[0], exposition.read_exposition(spark, path), 0, {"env": "prod"})]
    with splits_of(spark, 100):
        counts.append(ingest_dumps(stores[1], split_dumps.read_lines(spark, path), 0, {"env": "prod"}))
        # The same lines in other splits are the same batch.
        spark.conf.set(SPLIT, "70")
        assert ingest_dumps(stores[1], split_dumps.read_lines(spark, path), 0, {"env": "prod"}) == counts[1]
    assert counts[0] == counts[1] and counts[0].written > 0
    facts = [sorted(map(repr, s.facts().select("series_id", "time", "value").collect())) for s in stores]
    assert facts[0] == facts[1]
    marks = [sorted(map(repr, s.bookmarks().collect())) for s in stores]
    assert marks[0] == marks[1]


def test_one_dump_is_many_tasks_and_lines_are_shuffled_once(spark, tmp_path):
    path = written(tmp_path, "# TYPE a gauge\n" + "a 1\n" * 500)
    with splits_of(spark, 100):
        lines = split_dumps.read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 10
        assert lines.groupBy("block").count().agg(F.max("count")).first()[0] < 60
        typed = split_dumps.typed_lines(lines)
        typed.collect()
        plan = typed._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    # The text is read and shuffled in one place; other uses of it are the same exchange.
    assert final.count("Scan text") == 1, final
