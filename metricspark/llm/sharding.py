"""Weighted rendezvous hashing of record keys over shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.operators.ids import assign_ids
from metricspark.session import durable

#: Hexadecimal digits of the hash that are used: 52 bits, exact in a double.
DIGITS = 13


def _draw(text: Column, shard: Column) -> Column:
    digest = F.md5(F.concat(text, F.lit(":"), shard.cast("string")))
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16**DIGITS)


def _bid(text: Column, shard: Column, weight: Column) -> Column:
    return weight / -F.log(_draw(text, shard))


def _key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("null"))


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard whose bid for ``key`` is the highest; ties to the smaller shard.

    Shard ``s`` draws u in (0, 1) from a hash of key and ``s`` alone and bids
    ``-weight / ln(u)``, so it wins in proportion to its weight, and a further shard can
    only take keys for itself. A shard of weight 0 gets nothing.
    """
    if not weights or max(weights) <= 0 or min(weights) < 0:
        raise ValueError("weights must be 0 or more, and one of them above 0")
    text = _key_text(key)
    bids = F.array(
        *(
            F.struct(_bid(text, F.lit(s), F.lit(float(w))).alias("bid"), F.lit(-s).alias("order"))
            for s, w in enumerate(weights)
            if w > 0
        )
    )
    return -F.array_max(bids).getField("order")


def grown_shard(key: Column, shard: Column, weights: Sequence[float], added: float = 1.0) -> Column:
    """The shard once one of weight ``added`` is appended: ``shard``, unless it is outbid.

    The other bids do not change, so two draws tell."""
    text = _key_text(key)
    held = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), shard + 1)
    n = F.lit(len(weights))
    return F.when(_bid(text, n, F.lit(float(added))) > _bid(text, shard, held), n).otherwise(shard)


def assign_shards(docs: DataFrame, weights: Sequence[float], added: float = 1.0, key: str = "doc_id") -> DataFrame:
    """Put every row into a shard and number the rows of a shard without gaps.

    Returns ``key``, size (UTF-8 bytes of the text, null: none, plus 16), text_crc32, law,
    shard, slot and grown_shard (with one shard more). Rows of one key share a shard, null
    keys too; a shard of weight 0 stays empty. Slots follow key, size and checksum; rows
    equal in all of them are interchangeable. Other columns of ``docs`` are not read. An
    empty table gives no rows.

    Slots come from one range sort of the slim rows, so no task holds a whole shard; copies
    of one row are spread by a last sort key of their own.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    shard = rendezvous_shard(F.col(key), weights)
    rows = docs.select(
        F.col(key),
        (F.octet_length(text).cast("bigint") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard.cast("int").alias("shard"),
        F.xxhash64(F.monotonically_increasing_id()).alias("_spread"),
    ).withColumn("grown_shard", grown_shard(F.col(key), F.col("shard"), weights, added).cast("int"))
    fixed = durable(rows, "shards")
    numbered = assign_ids(fixed, ["shard", key, "size", "text_crc32", "_spread"], "_id", "bigint")
    firsts = numbered.groupBy(F.col("shard").alias("_shard")).agg(F.min("_id").alias("_first"))
    # One row per shard.
    return numbered.join(F.broadcast(firsts), F.col("shard") == F.col("_shard")).select(
        key, "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("_id") - F.col("_first")).alias("slot"),
        "grown_shard",
    )
