"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from metricspark.plans import oracles, registry
from tests.conftest import ROOT

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_its_sql(spark, sf_dir, sql, name):
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    result = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(repr(tuple(r[i] for i in order)) for r in result.fetchall())


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracles.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["sel_eq", "sel_contains", "group_by_label"])
def test_reads_are_pruned_by_a_literal_metric(spark, sf_dir, name):
    plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    physical = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "event_type" not in plan
    scan = physical[physical.index("chunk_start"):]
    assert "PartitionFilters: [isnotnull(metric_id" in scan and ") = " not in scan[: scan.index("PartitionFilters")]


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_no_local_checkpoints():
    for path in glob.glob(os.path.join(ROOT, "metricspark", "**", "*.py"), recursive=True):
        with open(path) as f:
            assert "localCheckpoint(" not in f.read(), path
