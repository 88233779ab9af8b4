import struct

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from metricspark.functions import labels as L
from metricspark.functions import matching, naming, values
from metricspark.functions.text import format_bytes


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def pairs(*kv):
    return F.array(*[L.label(k, v) for k, v in kv])


def as_pairs(labels):
    return [(p["key"], p["value"]) for p in labels]


def test_static_labels():
    assert L.parse_static_labels("") == []
    assert L.parse_static_labels("env=prod,app_1=a=b") == [("env", "prod"), ("app_1", "a=b")]
    for bad in ("env", "env=", "=x", "Env=x", "a b=c", "a=1,"):
        with pytest.raises(ValueError):
            L.parse_static_labels(bad)


def test_static_labels_come_first_and_own_labels_win(spark):
    own = pairs(("zone", "own"), ("b", "1"), ("b", "2"))
    merged = L.with_static_labels(own, {"env": "prod", "zone": "static"}, F.array(L.label("pod", "p"), L.label("ip", F.lit(None).cast("string"))))
    row = one(spark, merged, L.canonical_labels(F.lit("m"), merged))
    assert as_pairs(row[0]) == [("env", "prod"), ("zone", "static"), ("pod", "p"), ("zone", "own"), ("b", "1"), ("b", "2")]
    assert as_pairs(row[1]) == [("__name__", "m"), ("b", "2"), ("env", "prod"), ("pod", "p"), ("zone", "own")]


def test_target_without_labels(spark):
    merged = L.with_static_labels(pairs(("a", "1")), (), F.lit(None).cast("array<struct<key:string,value:string>>"))
    assert as_pairs(one(spark, merged)[0]) == [("a", "1")]


def test_sort_is_stable_and_bytewise(spark):
    row = one(spark, L.sorted_by_key(pairs(("b", "2"), ("a", "z"), ("b", "1"), ("_", "u"), ("B", "c"))))
    assert as_pairs(row[0]) == [("B", "c"), ("_", "u"), ("a", "z"), ("b", "2"), ("b", "1")]


def test_names(spark):
    at = lambda n: F.lit("x" * n)
    row = one(spark, *[naming.unique_name(at(n), F.lit("123")) for n in (61, 62, 80)])
    assert row[0] == "x" * 61
    assert row[1] == row[2] == "x" * 58 + "_123" and len(row[1]) == 62
    row = one(spark, naming.id_column_name(at(59), F.lit(7)), naming.id_column_name(at(58), F.lit(7)))
    assert row[0] == "x" * 57 + "_7_id" and row[1] == "x" * 58 + "_id"
    row = one(spark, *[naming.view_key(F.lit(k)) for k in ("time", "value", "series_id", "labels", "other")])
    assert list(row) == ["label_time", "label_value", "label_series_id", "label_labels", "other"]


def ids(*xs):
    return F.array(*[F.lit(x) for x in xs]).cast("array<int>")


def test_array_predicates(spark):
    labels = ids(1, 5, 0, 9)
    row = one(
        spark,
        matching.match_positive(labels, ids()), matching.match_negative(labels, ids()),
        matching.match_positive(labels, ids(9, 77)), matching.match_negative(labels, ids(9, 77)),
        matching.match_negative(labels, ids(77)),
        matching.contains(labels, ids()), matching.contains(labels, ids(5, 9)), matching.contains(labels, ids(5, -1)),
    )
    assert list(row) == [False, True, True, False, True, True, True, False]


def test_equality_forms(spark):
    row = one(
        spark,
        matching.eq(ids(1, 5, 9), ids(2, 9, 5)),
        matching.eq(ids(1, 7, 0, 9), ids(2, 0, 0, 9)),
        matching.eq_exact(ids(1, 7, 0, 9), ids(2, 0, 0, 9)),
        matching.eq(ids(1, 5), ids(2, 0, 5)),
        matching.eq_exact(ids(1, 5), ids(2, 0, 5)),
        matching.eq_matcher(ids(1, 5, 9), ids(9, 5)),
        matching.eq_matcher(ids(1), ids()),
        matching.eq_map(ids(1), F.create_map().cast("map<string,string>"), ids()),
        matching.eq_map(ids(1, 5), F.create_map(F.lit("__name__"), F.lit("m"), F.lit("k"), F.lit("v")), ids(5)),
    )
    assert list(row) == [True, True, False, False, True, True, None, True, True]


def test_marked_nans_from_a_file(spark, tmp_path):
    bits = [0x7FF0000000000002, 0x7FF8000000000001, 0x7FF8000000000000, 0x3FF0000000000000]
    doubles = [struct.unpack("<d", struct.pack("<Q", b))[0] for b in bits]
    path = str(tmp_path / "special.parquet")
    pq.write_table(pa.table({"i": list(range(4)) + [4], "v": pa.array([*doubles, None], pa.float64(), from_pandas=False)}), path)
    df = spark.read.parquet(path).withColumn("kind", values.sample_kind(F.col("v")))
    got = [(r["kind"], r["s"], r["n"]) for r in df.select("i", "kind", values.is_stale_marker(F.col("kind")).alias("s"), values.is_normal_nan(F.col("kind")).alias("n")).orderBy("i").collect()]
    assert got == [("stale", True, False), ("normal_nan", False, True), ("other_nan", False, False), ("value", False, False), (None, None, None)]
    stored = str(tmp_path / "stored")
    df.write.parquet(stored)
    assert {r["kind"] for r in spark.read.parquet(stored).collect()} == {"stale", "normal_nan", "other_nan", "value", None}


def test_format_bytes(spark):
    row = one(spark, *[format_bytes(F.lit(n)) for n in (0, 1536, 1048576, 1048577, 3 * 1048576)])
    assert list(row) == ["0.0 KiB", "1.5 KiB", "1024.0 KiB", "1.0 MiB", "3.0 MiB"]
