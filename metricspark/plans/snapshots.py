"""A small table a stream carries from batch to batch, written whole by each batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from metricspark.session import hadoop_path

#: Tables that are kept, for batches run again and for readers that still hold one.
KEPT = 8


def read_or_empty(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A parquet table that may not have been written yet."""
    path, files = hadoop_path(spark, folder)
    return spark.read.schema(schema).parquet(folder) if files.exists(path) else spark.createDataFrame([], schema)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of a stream as a writer, kept in its checkpoint. A checkpoint that is deleted and
    made again under its old path starts at batch 0 and is another stream."""
    path, files = hadoop_path(spark, f"{checkpoint.rstrip('/')}/writer")
    found = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
    if found:
        return found[0]
    name = uuid.uuid4().hex
    files.mkdirs(hadoop_path(spark, f"{path.toString()}/{name}")[0])
    return name


class Snapshots:
    """``<folder>/<number>-<stream>-<batch>`` holds the table as a batch of a stream left it.

    Numbers grow over all streams, so a stream with a new checkpoint goes on from what the one
    before it left. A batch run again reads what it read the first time and takes its own place.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.schema = schema

    def _held(self) -> list[tuple[int, str, int]]:
        """(number, stream, batch) of the complete tables, in order; few are kept."""
        path, files = hadoop_path(self.spark, self.folder)
        if not files.exists(path):
            return []
        names = [s.getPath().getName() for s in files.listStatus(path)]
        whole = [n for n in names if files.exists(hadoop_path(self.spark, f"{self.folder}/{n}/_SUCCESS")[0])]
        return sorted((int(number), stream, int(batch)) for number, stream, batch in (n.split("-") for n in whole))

    def latest(self, before: tuple[str, int] | None = None) -> DataFrame:
        """The newest table, or the one that a (stream, batch) found; it may have no rows."""
        held = [h for h in self._held() if h[1:] != before]
        if not held:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._path(*held[-1]))

    def write(self, rows: DataFrame, stream: str, batch: int) -> None:
        held = self._held()
        own = [h for h in held if h[1:] == (stream, batch)]
        number = own[-1][0] if own else 1 + max((h[0] for h in held), default=-1)
        rows.write.mode("overwrite").parquet(self._path(number, stream, batch))
        for old in self._held()[:-KEPT]:
            path, files = hadoop_path(self.spark, self._path(*old))
            files.delete(path, True)

    def _path(self, number: int, stream: str, batch: int) -> str:
        return f"{self.folder}/{number}-{stream}-{batch}"
