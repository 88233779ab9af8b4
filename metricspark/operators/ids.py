"""Dense ids without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricspark.session import durable


def assign_ids(
    rows: DataFrame, order_by: Sequence[str], id_column: str, id_type: str = "int", after: DataFrame | int | None = None
) -> DataFrame:
    """Number distinct ``rows`` densely in the order of ``order_by``.

    Ids start at 1, or past ``after``: a number, or the highest ``id_column`` of a table.

    The rows are range-partitioned and sorted, and written once with their partition and
    their rank inside it, so that both stay fixed if a task runs again. The offsets of the
    partitions (one row per partition) are then added by a broadcast join. No task sees more
    than one range.
    """
    ranged = (
        rows.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_rank"),
        )
    )
    fixed = durable(ranged, f"ids-{id_column}")
    counts = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    first = after if isinstance(after, int) else 0
    if isinstance(after, DataFrame):
        # The ids already given count as a partition before the first.
        given = after.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint").alias("_n"))
        counts = counts.unionByName(given.select(F.lit(-1).alias("_part"), "_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = (F.col("_rank") + F.col("_offset") + 1 + first).cast(id_type)
    # One row per partition of the write: bounded by the shuffle partition count.
    return fixed.join(F.broadcast(offsets), "_part").select(numbered.alias(id_column), *rows.columns)
