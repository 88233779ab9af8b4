"""Preference pairs as one prompt and two masked completions, turn by turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.session import durable

CHOSEN, REJECTED, PROMPT = "chosen", "rejected", "prompt"


def render(role: Column, text: Column) -> Column:
    """A turn as text: its role as a header line, then what was said."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n"))


def preference_segments(branches: DataFrame, learner: str = "assistant") -> DataFrame:
    """Split each pair of conversations where their turns first differ.

    ``branches`` has pair_id, side ("chosen" or "rejected"), turn, role and text. Returns one
    row per turn of each part: pair_id, part ("prompt", once for both sides, "chosen" or
    "rejected"), turn, rendered (header and text), header_length and trained: true for the
    learner's turns of a completion. A loss counts the characters of trained rows from
    header_length on; everything else is masked.

    The prompt is the longest common prefix: all turns before the first number at which the
    sides differ in role or text (nulls are equal to nulls only) or only one side has a turn.
    Equal sides are all prompt; sides that differ at once have none. Rows without pair_id,
    turn or a known side are left out; of several rows for one turn of a side the smallest
    (role, text) counts. Null text renders as empty, null role as "unknown". Other columns
    are not read. An empty table gives no rows.

    Sides meet by an aggregation on (pair_id, turn), and the first difference is a minimum
    with map-side combine, so a conversation is never gathered, whatever its length.
    """
    said = F.struct(F.col("role"), F.col("text"))
    placed = branches.where(F.col("pair_id").isNotNull() & F.col("turn").isNotNull() & F.col("side").isin(CHOSEN, REJECTED))
    both = placed.groupBy("pair_id", "turn").agg(
        F.min(F.when(F.col("side") == CHOSEN, said)).alias("c"), F.min(F.when(F.col("side") == REJECTED, said)).alias("r")
    )
    both = durable(both, "sides")
    differ = ~F.col("c").eqNullSafe(F.col("r"))
    split = both.where(differ).groupBy(F.col("pair_id").alias("_pair")).agg(F.min("turn").alias("_split"))
    parted = both.join(split, F.col("pair_id") == F.col("_pair"), "left")
    shared = F.col("_split").isNull() | (F.col("turn") < F.col("_split"))

    def segment(part: Column, side: str) -> Column:
        return F.struct(part.alias("part"), F.col(f"{side}.role").alias("role"), F.col(f"{side}.text").alias("text"))

    parts = F.when(shared, F.array(segment(F.lit(PROMPT), "c"))).otherwise(
        F.filter(
            F.array(
                F.when(F.col("c").isNotNull(), segment(F.lit(CHOSEN), "c")),
                F.when(F.col("r").isNotNull(), segment(F.lit(REJECTED), "r")),
            ),
            lambda s: s.isNotNull(),
        )
    )
    rows = parted.select("pair_id", "turn", F.explode(parts).alias("s"))
    role, text = F.col("s.role"), F.col("s.text")
    return rows.select(
        "pair_id",
        F.col("s.part").alias("part"),
        "turn",
        render(role, text).alias("rendered"),
        (F.length(render(role, F.lit(""))) - 1).cast("int").alias("header_length"),
        ((F.col("s.part") != PROMPT) & role.eqNullSafe(F.lit(learner))).alias("trained"),
    )


def assemble(segments: DataFrame) -> DataFrame:
    """One row per pair: prompt, chosen, rejected and for each completion the (start, end)
    character ranges that a loss counts. For conversations that fit a row."""

    def joined(part: str) -> Column:
        own = F.filter("turns", lambda t: t.getField("part") == part)
        return F.array_join(F.transform(own, lambda t: t.getField("rendered")), "")

    def ranges(part: str) -> Column:
        own = F.filter("turns", lambda t: t.getField("part") == part)
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("spans"))

        def add(held: Column, t: Column) -> Column:
            end = held.getField("at") + F.length(t.getField("rendered"))
            span = F.array(F.struct((held.getField("at") + t.getField("header_length")).alias("start"), end.alias("end")))
            spans = F.when(t.getField("trained"), F.concat(held.getField("spans"), span)).otherwise(held.getField("spans"))
            return F.struct(end.alias("at"), spans.alias("spans"))

        return F.aggregate(own, start, add, lambda held: held.getField("spans"))

    turns = F.sort_array(F.collect_list(F.struct("turn", "part", "rendered", "header_length", "trained")))
    return segments.groupBy("pair_id").agg(turns.alias("turns")).select(
        "pair_id",
        *(joined(p).alias(p) for p in (PROMPT, CHOSEN, REJECTED)),
        *(ranges(p).alias(f"{p}_spans") for p in (CHOSEN, REJECTED)),
    )


def last_reply_branches(turns: DataFrame, learner: str = "assistant") -> DataFrame:
    """Pairs from single conversations: chosen is a conversation as it is; rejected is the
    same up to its last reply, where it goes on like the neighbouring conversation
    (conv_id with the lowest bit flipped) from that turn number on.

    Columns pair_id (the conversation), side, turn, role and text; other columns are not read."""
    turns = turns.select("conv_id", "turn", "role", "text")
    cuts = turns.groupBy(F.col("conv_id").alias("pair_id")).agg(
        F.coalesce(F.max(F.when(F.col("role") == learner, F.col("turn"))), F.lit(0)).alias("cut")
    )
    own = turns.join(cuts, F.col("conv_id") == F.col("pair_id"))
    other = turns.join(cuts, F.col("conv_id").bitwiseXOR(F.lit(1)) == F.col("pair_id"))
    columns = ("turn", "role", "text")
    return (
        own.select("pair_id", F.lit(CHOSEN).alias("side"), *columns)
        .unionByName(own.where("turn < cut").select("pair_id", F.lit(REJECTED).alias("side"), *columns))
        .unionByName(other.where("turn >= cut").select("pair_id", F.lit(REJECTED).alias("side"), *columns))
    )
