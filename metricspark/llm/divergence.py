"""How far the term use of the sources of a language lies apart, by count-level bitmaps."""

from __future__ import annotations

import string
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricspark.llm.text import shuffles_removed, slices
from metricspark.operators.ids import assign_ids
from metricspark.session import durable

#: Documents of its language that a kept term is in.
MIN_DOCS = 30
#: Occurrences added to each count, and the scale of a share.
PRIOR = 5
SCALE = 1_000_000_000
#: Ranks of the part ``term``.
TOP_TERMS = 50
#: Different (group, term) entries a task counts before it hands them on.
HELD = 300_000
#: Terms of a bitmap word.
WORD_BITS = 64

_LETTERS = {*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: A-Z in small letters, and a blank for every byte that ends a term.
_TERM_BYTES = bytes(b | 0x20 if chr(b) in string.ascii_uppercase else b if b in _LETTERS else 0x20 for b in range(256))

GROUP = ["lang", "source"]


def _terms(text: bytes | None) -> list[bytes]:
    return text.translate(_TERM_BYTES).split() if text else []


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, n_docs``: occurrences and documents of each term in each group.

    Tasks add up before the shuffle, so a hot source or term is one row per task and flush.
    """
    schema = pa.schema(
        [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("n_docs", pa.int64())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
        entries = 0
        for batch in slices(batches):
            texts = batch.column(2).cast(pa.binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                terms = _terms(text.as_py())
                n, n_docs = held[lang, source]
                entries -= len(n)
                n.update(terms)
                n_docs.update(set(terms))
                entries += len(n)
            if entries > HELD:
                yield from flush(held)
                entries = 0
        yield from flush(held)

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, n_docs) in held.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()),
                    pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                    pa.array([n_docs[t] for t in n], pa.int64()),
                ],
                schema=schema,
            )
        held.clear()

    partial = _plain(docs, "text").mapInArrow(count, "lang string, source string, term string, n bigint, n_docs bigint")
    return partial.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def _plain(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in [*GROUP, *more]))


def share(count: Column, total: Column, terms: Column) -> Column:
    """Smoothed share of a term, in units of 1 / SCALE from 1 on, exact; null without terms."""
    exact = lambda c, digits: c.cast(f"decimal({digits},0)")
    above = exact(count + PRIOR, 20) * F.lit(SCALE).cast("decimal(10,0)")
    parts = F.call_function("div", above, exact(total + PRIOR * terms, 20))
    return F.when(terms > 0, parts.cast("bigint") + 1)


def count_levels(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, word, n, bits``, with the shares ``p`` of the level and ``p0`` of count 0.

    Per group and count n the set of the terms with that count, as a bitset of term ids cut
    into words of 64 terms; words without a term are left out. Ids follow the terms'
    frequency, so neighbours tend to share a level.
    """
    bit = F.expr(f"shiftleft(1L, CAST(id % {WORD_BITS} AS INT))")
    sets = kept.select(*GROUP, F.expr(f"id div {WORD_BITS}").alias("word"), "n", bit.alias("bit"))
    words = sets.groupBy(*GROUP, "word", "n").agg(F.bit_or("bit").alias("bits"))
    return words.join(groups, GROUP).select(
        *GROUP, "word", "n", "bits", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "p0"
    )


def pair_divergence(levels: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: the sum over all kept terms of ``|p - q|`` for each ordered
    pair of sources of a language.

    Cells of two counts above 0 come from AND and popcount of two words. A cell with a zero is
    the complement: the terms of a level less those its other cells took; so each level counts
    against the other's zero as a whole, and each joint cell takes back what it was counted
    for. What neither group has is the complement of both. Only pairs of sources of one
    language and one word meet, a word at a time; the result has a row per pair of sources.
    """
    a, b = levels.alias("a"), levels.alias("b")
    both = F.expr("a.bits & b.bits")
    same = (F.col("a.lang") == F.col("b.lang")) & (F.col("a.word") == F.col("b.word"))
    gap = lambda x, y: F.abs(F.col(x) - F.col(y))
    correction = gap("a.p", "b.p") - gap("a.p", "b.p0") - gap("a.p0", "b.p") + gap("a.p0", "b.p0")
    joint = (
        a.join(b, same & (F.col("a.source") < F.col("b.source")) & (both != 0))
        .groupBy(F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item"))
        .agg(F.sum(F.bit_count(both) * correction).alias("value"))
    )
    sizes = levels.groupBy(*GROUP, "p", "p0").agg(F.sum(F.bit_count("bits")).alias("size"))
    other = groups.alias("b")
    apart = (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source"))
    pair = [F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item")]
    alone = (
        sizes.alias("a").join(other, apart).groupBy(*pair)
        .agg(F.sum(F.col("size") * (gap("a.p", "b.p0") - gap("a.p0", "b.p0"))).alias("value"))
    )
    neither = groups.alias("a").join(other, apart).select(*pair, F.coalesce(F.col("a.terms") * gap("a.p0", "b.p0"), F.lit(0)).alias("value"))
    halves = joint.unionByName(alone)
    swapped = halves.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    return neither.unionByName(halves).unionByName(swapped).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def excess_terms(kept: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """``lang, source, item, value``: the terms a group uses more than its language does."""
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    q = share(F.col("in_lang"), F.col("lang_total"), F.col("terms"))
    with_totals = kept.join(groups, GROUP).join(langs.drop("terms"), "lang")
    return with_totals.select(*GROUP, F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), F.asc("item"))
    return rows.select(*GROUP, F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Every pair of sources of each language, and the terms each source uses most in excess.

    Null text, lang and source are read as ''. Each row of ``docs`` is a document of its own,
    repeated or not. Languages without kept terms have pairs of value 0; empty texts make a
    group without terms; an empty table gives no rows. Ties go to the smaller item. Other
    columns are not read. Ranks of the part ``pair`` are all given, of ``term`` up to
    ``top_terms``, cut in each task before rows of a group meet.
    """
    with shuffles_removed(docs.sparkSession):
        counts = durable(term_counts(docs), "term-counts")
        terms = counts.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("in_lang"))
        frequent = durable(terms.where(F.col("n_docs") >= min_docs).select("lang", "in_lang", "term"), "kept-terms")
        numbered = durable(assign_ids(frequent, ["lang", "in_lang", "term"], "id", "bigint"), "term-ids")
        kept = durable(counts.drop("n_docs").join(numbered, ["lang", "term"]), "kept-counts")
        langs = numbered.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("in_lang").alias("lang_total"))
        totals = kept.groupBy(*GROUP).agg(F.sum("n").alias("total"))
        zero = F.lit(0).cast("bigint")
        groups = durable(
            _plain(docs).distinct().join(totals, GROUP, "left").join(langs.select("lang", "terms"), "lang", "left")
            .select(*GROUP, F.coalesce("total", zero).alias("total"), F.coalesce("terms", zero).alias("terms"))
            .withColumn("p0", share(zero, F.col("total"), F.col("terms"))),
            "groups",
        )
        levels = durable(count_levels(kept, groups), "levels")
        pairs = durable(pair_divergence(levels, groups), "pairs")
    excess = _ranked(excess_terms(kept, groups, langs), "term").where(F.col("rank") <= top_terms)
    return _ranked(pairs, "pair").unionByName(excess)
