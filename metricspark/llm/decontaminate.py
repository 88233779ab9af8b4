"""Benchmark decontamination by winnowing: shared fingerprints find the documents, exact windows decide."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.llm.text import alnum_words, let, shifted
from metricspark.session import durable

#: Words of a window that counts as contamination; an item of fewer words is one window.
WINDOW = 10
#: Words of a fingerprinted k-gram.
GRAM = 4


def neighbours(items: Column, step: int, join: Callable[[Column, Column], Column]) -> Column:
    """``join`` of each entry with the one ``step`` later."""
    return let(items, lambda x: F.zip_with(shifted(x, 0, step), shifted(x, step, step), join))


def gram_hashes(words: Column) -> Column:
    """Hash of each run of GRAM (4) words, made by hashing neighbours twice."""
    one = F.transform(words, lambda w: F.xxhash64(w))
    two = neighbours(one, 1, lambda a, b: F.xxhash64(a, b))
    return neighbours(two, 2, lambda a, b: F.xxhash64(a, b))


def winnow(words: Column, window: int = WINDOW) -> Column:
    """The smallest k-gram hash of each ``window`` consecutive words, distinct.

    Two texts that share ``window`` consecutive words share all k-grams inside them, so
    they share the smallest: no such span is missed. Texts of fewer words give nothing.
    """
    hashes, width = gram_hashes(words), 1
    span = window - GRAM + 1
    while width < span:
        step = min(width, span - width)
        hashes = neighbours(hashes, step, lambda a, b: F.least(a, b))
        width += step
    return F.array_distinct(hashes)


def windows_at(words: Column, length: Column) -> Column:
    """Runs of ``length`` consecutive words, each joined by a blank, in text order."""
    def cut(w: Column) -> Column:
        starts = F.when(F.size(w) >= length, F.sequence(F.lit(1), F.size(w) - length + 1)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, length), " "))

    return let(words, cut)


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, width, text) of each distinct window of each item with an id and words."""
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", alnum_words(F.col("text")).alias("words"))
    width = F.least(F.size("words"), F.lit(window))
    items = items.where(F.size("words") > 0).withColumn("width", width)
    return items.select("item_id", "width", F.explode(windows_at(F.col("words"), F.col("width"))).alias("window")).distinct()


def contaminated_keys(docs: DataFrame, benchmark: DataFrame, prints: DataFrame, window: int) -> DataFrame:
    """(doc_id, _key) of the documents that share a fingerprint, or a short item's anchor word."""
    words = alnum_words(F.col("text"))
    items = benchmark.where(F.col("item_id").isNotNull()).select(words.alias("words"))
    wanted = items.select(F.explode(winnow(F.col("words"), window)).alias("print")).distinct()
    found = prints.select("doc_id", "_key", F.explode("prints").alias("print")).join(wanted, "print", "left_semi")
    keys = found.select("doc_id", "_key")
    short = items.where(F.size("words").between(1, window - 1))
    if not short.isEmpty():
        # Too short for a fingerprint: its longest word must be in the document.
        longest = F.array_max(F.transform("words", lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))
        anchors = short.select(longest.getField("w").alias("word")).distinct()
        said = docs.select("doc_id", "_key", F.explode(F.array_distinct(words)).alias("word"))
        keys = keys.unionByName(said.join(anchors, "word", "left_semi").select("doc_id", "_key"))
    return keys.distinct()


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Count, per row of ``docs``, the words inside any occurrence of a benchmark window.

    Returns doc_id, _key (a hash of the text), n_words, n_hit, n_items, items_sha256 and
    contaminated. A null text has no words; items without id or words take no part;
    repeated items count once by id. Rows equal in doc_id and text get equal results, rows
    that share a doc_id only are told apart by their texts. Other columns are not read.

    One pass makes and stores the fingerprints of all documents. They meet the benchmark's
    by an equi join, which Spark broadcasts if the benchmark is small and sorts else. Only
    documents with a hit are read again; all their windows are then compared as text, so
    that hash collisions and near misses do not count.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_key"))
    words = alnum_words(F.col("text"))
    made = let(
        words, lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), winnow(w, window).alias("prints"))
    )
    prints = durable(keyed.select("doc_id", "_key", made.alias("_made")).select("doc_id", "_key", "_made.*"), "winnow")
    keys = durable(contaminated_keys(keyed, benchmark, prints, window), "winnow-keys")
    wanted = durable(item_windows(benchmark, window), "winnow-items")
    widths = [r["width"] for r in wanted.select("width").distinct().collect()]  # at most `window` numbers
    same = keys.select(F.col("doc_id").alias("_doc"), F.col("_key").alias("_hash"))
    suspects = keyed.join(same, (F.col("_key") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    suspects = suspects.dropDuplicates(["doc_id", "_key"]).select("doc_id", "_key", words.alias("_words"))
    spans = [
        suspects.select(
            "doc_id", "_key", F.lit(width).alias("width"), F.posexplode(windows_at(F.col("_words"), F.lit(width))).alias("at", "window")
        )
        for width in sorted(widths)
    ]
    if not spans:
        return _result(prints, None, None)
    found = spans[0]
    for more in spans[1:]:
        found = found.unionByName(more)
    texts = wanted.select("width", "window").distinct()
    hits = durable(found.join(texts, ["width", "window"]), "winnow-hits")
    covered = hits.select("doc_id", "_key", F.explode(F.sequence("at", F.col("at") + F.col("width") - 1)).alias("word")).distinct()
    n_hit = covered.groupBy("doc_id", "_key").agg(F.count(F.lit(1)).alias("n_hit"))
    pairs = hits.select("doc_id", "_key", "width", "window").distinct().join(wanted, ["width", "window"])
    named = pairs.select("doc_id", "_key", "item_id").distinct()
    # The list of a document's items is the result itself.
    ids = F.sort_array(F.collect_list(F.col("item_id").cast("string")))
    items = named.groupBy("doc_id", "_key").agg(F.count(F.lit(1)).alias("n_items"), F.array_join(ids, ",").alias("_items"))
    return _result(prints, n_hit, items)


def _result(prints: DataFrame, n_hit: DataFrame | None, items: DataFrame | None) -> DataFrame:
    rows = prints.select("doc_id", "_key", "n_words")
    if n_hit is None:
        rows = rows.select("*", F.lit(0).alias("n_hit"), F.lit(0).alias("n_items"), F.lit("").alias("_items"))
    else:
        found = n_hit.join(items, (n_hit["_key"] == items["_key"]) & n_hit["doc_id"].eqNullSafe(items["doc_id"])).select(
            n_hit["doc_id"].alias("_doc"), n_hit["_key"].alias("_hash"), "n_hit", "n_items", "_items"
        )
        rows = rows.join(found, (F.col("_key") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    n = F.coalesce(F.col("n_hit"), F.lit(0)).cast("bigint")
    return rows.select(
        "doc_id",
        "_key",
        "n_words",
        n.alias("n_hit"),
        F.coalesce(F.col("n_items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.col("_items"), F.lit("")), 256).alias("items_sha256"),
        (n > 0).alias("contaminated"),
    )
