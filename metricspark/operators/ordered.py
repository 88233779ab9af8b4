"""The previous row of a key, without sorting all rows of a hot key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def previous_in_order(
    rows: DataFrame, key: str, order: Sequence[str], values: Sequence[str], bucket_size: int, prefix: str = "prev_"
) -> DataFrame:
    """Add ``prev_<v>`` for each of ``values``: the value on the previous row of the same key.

    ``order`` starts with an integer column, which is cut into buckets of ``bucket_size``.
    Rows are sorted within (key, bucket); only the first row of a bucket takes its values
    from the last row of the bucket before, of which there is one summary row each, found by
    map-side aggregation. A key with most of the data is so spread over its buckets.
    """
    bucket = F.floor(F.col(order[0]) / bucket_size)
    in_bucket = Window.partitionBy(key, "_bucket").orderBy(*order)
    current = F.struct(*values)
    placed = rows.withColumn("_bucket", bucket)
    lagged = placed.withColumn("_prev", F.lag(current).over(in_bucket))
    last = placed.groupBy(key, "_bucket").agg(F.max_by(current, F.struct(*order)).alias("_last"))
    before = last.select(
        key, "_bucket", F.lag("_last").over(Window.partitionBy(key).orderBy("_bucket")).alias("_carried")
    ).filter(F.col("_carried").isNotNull())
    joined = lagged.join(before, [key, "_bucket"], "left").withColumn("_prev", F.coalesce("_prev", "_carried"))
    return joined.select(*rows.columns, *[F.col(f"_prev.{v}").alias(f"{prefix}{v}") for v in values])
