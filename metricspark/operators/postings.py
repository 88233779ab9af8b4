"""An index from labels to series: bitmaps of series ids, combined by and, or and not.

A row holds 64 series of one metric, a bit each, that use one label. A matcher is the or of the
words of its label ids, matchers are put together by and, and negative ones taken out by and-not,
word by word, so that a selector reads the postings of its labels and no series. Ids are never
given again, so bits of series that are gone meet nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.operators.selectors import Matcher, equal, metric_id
from metricspark.schema import NAME_KEY, Catalog

WORD_BITS = 64


def postings(series: DataFrame) -> DataFrame:
    """``metric_id, id, word, bits`` of series; rows of several batches are combined by or."""
    used = series.select("metric_id", "series_id", F.explode("label_ids").alias("id")).where("id <> 0")
    bit = F.expr(f"shiftleft(1L, CAST(series_id % {WORD_BITS} AS INT))")
    word = F.expr(f"series_id div {WORD_BITS}")
    return used.groupBy("metric_id", "id", word.alias("word")).agg(F.bit_or(bit).alias("bits"))


def _words(index: DataFrame, ids: DataFrame, number: int) -> DataFrame:
    """The words of one matcher: its labels' words combined by or."""
    mine = index.join(ids, "id", "left_semi")
    return mine.groupBy("word").agg(F.bit_or("bits").alias("bits")).withColumn("matcher", F.lit(number))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def select_ids(catalog: Catalog, index: DataFrame, metric_name: str, *matchers: Matcher) -> DataFrame:
    """``metric_id, series_id`` of the series of a metric that all matchers accept.

    A key the metric does not have matches no id: a positive matcher then accepts nothing and a
    negative one everything. Without a positive matcher all series of the metric start, which
    the metric's own name label has."""
    mine = metric_id(catalog, metric_name)
    own = index.where(F.col("metric_id") == mine)
    wanted = [m for m in matchers if m.positive] or [equal(NAME_KEY, metric_name)]
    chosen = (
        _all([_words(own, m.ids(catalog.label), n) for n, m in enumerate(wanted)])
        .groupBy("word").agg(F.bit_and("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == len(wanted))
    )
    barred = [m for m in matchers if not m.positive]
    if barred:
        out = _all([_words(own, m.ids(catalog.label), n) for n, m in enumerate(barred)])
        out = out.groupBy("word").agg(F.bit_or("bits").alias("out"))
        left = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("out", F.lit(0).cast("bigint"))))
        chosen = chosen.join(out, "word", "left").select("word", left.alias("bits"))
    spread = F.explode(F.filter(F.sequence(F.lit(0), F.lit(WORD_BITS - 1)), lambda b: F.getbit("bits", b) == 1))
    return chosen.select("word", spread.alias("bit")).select(
        F.lit(mine).cast("int").alias("metric_id"), (F.col("word") * WORD_BITS + F.col("bit")).alias("series_id")
    )


def select_series(catalog: Catalog, index: DataFrame, metric_name: str, *matchers: Matcher) -> DataFrame:
    """The same as rows of the series table."""
    ids = select_ids(catalog, index, metric_name, *matchers)
    own = catalog.series.where(F.col("metric_id") == metric_id(catalog, metric_name))
    return own.join(ids, ["metric_id", "series_id"], "left_semi")


def select_containing(catalog: Catalog, index: DataFrame, metric_name: str, pairs: Mapping[str, str]) -> DataFrame:
    """Series with every listed pair. The metric name is ignored, an unknown pair matches
    nothing, and no pairs match everything."""
    return select_series(catalog, index, metric_name, *(equal(k, v) for k, v in pairs.items() if k != NAME_KEY))
