r"""Exposition dumps of any size, read by line splits instead of one row per dump.

A dump is cut where its file is, into blocks of ``spark.sql.files.maxPartitionBytes`` at most,
so one dump spreads over many tasks. Order inside a block is that of reading; blocks are in
order of their place in the file. What a line needs from before its block reaches it by
summaries: one row per block for a help text that goes on, and for the number of lines; one
row per block and name for the types that names have. Lines are shuffled once, by block, and no
group is larger than a block, but for the summaries of one dump, or of one name in it.

The rows equal those of ``exposition.typed_lines`` over the same files. A dump that holds no
lines gives none. Files that cannot be split (compressed ones) are one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricspark.sources import exposition

_DOC = ("doc_id", "target", "scrape_ts", "outcome")
_BLOCK = (*_DOC, "block")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the dumps under ``target=…/scrape_ts=…/`` folders: the columns of
    ``read_exposition`` with ``text`` for the body, ``block`` (where the line's split begins in
    its file) and ``at``, which grows along a block."""
    files = spark.read.schema("value string, target string, scrape_ts bigint").format("text").option("lineSep", "\n")
    value = F.col("value")
    return files.load(path).select(
        F.col("_metadata.file_path").alias("doc_id"),
        "target",
        "scrape_ts",
        F.lit("ok").alias("outcome"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.when(value.endswith("\r"), F.left(value, F.length(value) - 1)).otherwise(value).alias("text"),
    )


def _so_far(*columns: str):
    return Window.partitionBy(*columns).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier(order: list[str], *columns: str):
    return Window.partitionBy(*columns).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _same(left: DataFrame, right: DataFrame, columns: tuple[str, ...]) -> Column:
    """Equality of the columns, nulls included: a folder without a value reads as null."""
    condition = F.lit(True)
    for c in columns:
        condition &= left[c].eqNullSafe(right[f"_{c}"])
    return condition


def _renamed(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return rows.withColumnsRenamed({c: f"_{c}" for c in columns})


def without_help(lines: DataFrame) -> DataFrame:
    """The lines that belong to no help text.

    A line does if a help line came after the last line before it that does not end in a
    backslash. Where a block has no such line yet, the blocks before it tell: the last of them
    whose end depends on itself alone."""
    continued, is_help = F.col("text").endswith("\\"), F.col("text").startswith(exposition.HELP_PREFIX)
    marked = lines.withColumns(
        {
            "ended": F.max(F.when(~continued, F.col("at"))).over(_earlier(["at"], *_BLOCK)),
            "helped": F.max(F.when(is_help, F.col("at"))).over(_so_far(*_BLOCK)),
        }
    ).withColumn("own", F.col("helped").isNotNull() & (F.col("ended").isNull() | (F.col("helped") > F.col("ended"))))
    # Null where the state at the block's end is that at its beginning.
    at_end = F.when(~continued, False).when(F.col("own"), True).when(F.col("ended").isNotNull(), False)
    ends = marked.groupBy(*_BLOCK).agg(F.max_by(F.struct(at_end.alias("open")), "at").alias("end"))
    opened = F.last("end.open", ignorenulls=True).over(_earlier(["block"], *_DOC))
    open_blocks = _renamed(ends.withColumn("opened", opened).where("opened").select(*_BLOCK), _BLOCK)
    beginning = marked.where("NOT own")
    goes_on = _same(beginning, open_blocks, _BLOCK) & beginning["ended"].isNull()
    return beginning.join(open_blocks, goes_on, "left_anti").select(*lines.columns)


def typed_lines(lines: DataFrame) -> DataFrame:
    """Sample lines with ``line`` (their order in the dump), ``text`` and ``series_type``, as
    ``exposition.typed_lines`` gives them."""
    text = F.col("text")
    declares = text.startswith(exposition.TYPE_PREFIX)
    counted = without_help(lines).where(declares | exposition._is_sample_line(text)).withColumn(
        "n", F.count(F.when(~declares, 1)).over(_so_far(*_BLOCK))
    )
    name = exposition._name(exposition._head(text))
    sample = F.array(F.struct(name.alias("name"), F.lit(None).cast("string").alias("series_type")))
    entries = F.when(declares, exposition._registered(exposition._type_words(text))).otherwise(sample)
    named = counted.withColumns({"declares": declares, "entry": F.explode(entries)}).select(
        *_BLOCK, "at", "text", "n", "declares", "entry.name", "entry.series_type"
    )
    of_name = (*_BLOCK, "name")
    typed = named.withColumn("series_type", F.last("series_type", ignorenulls=True).over(_so_far(*of_name)))
    samples = typed.where("NOT declares")

    # The type a name has when a block begins; asked for only where a block has lines before its
    # own declaration, which are sorted before it.
    declared = named.where("declares").groupBy(*of_name).agg(F.max_by("series_type", "at").alias("declared"))
    asked = samples.where("series_type IS NULL").select(*of_name).distinct().withColumn("declared", F.lit(None).cast("string"))
    both = asked.withColumn("rank", F.lit(0)).unionByName(declared.withColumn("rank", F.lit(1)))
    before = F.last("declared", ignorenulls=True).over(_earlier(["block", "rank"], *_DOC, "name"))
    carried = both.withColumn("carried", before).where("rank = 0 AND carried IS NOT NULL").select(*of_name, "carried")

    # Lines of the blocks before.
    sizes = counted.groupBy(*_BLOCK).agg(F.max("n").alias("size"))
    first = sizes.withColumn("first", F.coalesce(F.sum("size").over(_earlier(["block"], *_DOC)), F.lit(0)))
    offsets = _renamed(first.select(*_BLOCK, "first"), _BLOCK)
    carried = _renamed(carried, of_name)
    placed = samples.join(offsets, _same(samples, offsets, _BLOCK)).select(*samples.columns, "first")
    return placed.join(carried, _same(placed, carried, of_name), "left").select(
        *_DOC,
        (F.col("first") + F.col("n") - 1).cast("int").alias("line"),
        "text",
        F.coalesce("series_type", "carried").alias("series_type"),
    )


def parse_lines(lines: DataFrame, counter_mode: str = "integer", timestamp_unit: str = "ms") -> DataFrame:
    """Lines of dumps to samples, with the rows of ``exposition.parse_exposition``."""
    return exposition.parse_typed(typed_lines(lines), counter_mode, timestamp_unit)
