"""Column and plain-Python text helpers shared by the operators."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Everything in ASCII that is neither a digit nor a small letter ends a word.
ALNUM_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as no column of ``df`` has."""
    while name in df.columns:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z in small letters, every other character as it is.

    An all-ASCII text, told by its byte count, takes the quick built-in.
    """
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def alnum_words(text: Column) -> Column:
    """Words of small letters, digits and non-ASCII characters; null gives no words."""
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), ALNUM_BREAK), "")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` worked out once, however often ``then`` names it."""
    return F.transform(F.array(value), then).getItem(0)


def shifted(items: Column, by: int, drop: int) -> Column:
    """``items`` from position ``by`` on, ``drop`` entries shorter than the whole; empty if too short."""
    return F.slice(items, F.lit(by + 1), F.greatest(F.size(items) - drop, F.lit(0)))


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in small letters, as UTF-8."""
    return text.encode().lower().split() if text else []


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside give up their shuffle files when they end, not when the driver
    collects its garbage. For steps whose results are stored or collected."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Queries run inside hand at most ``rows`` rows at once to Python, so that each task holds less
    of them outside the heap, on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that few are Python objects at once."""
    return (batch.slice(at, rows) for batch in batches for at in range(0, batch.num_rows, rows))
