"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "metricspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: adaptive execution with
    skew handling, UTC, and Arrow for the few pandas functions."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting falls back to a temporary folder: on
    a cluster a machine-local folder would lose the data with its executor.
    """
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF)
    if root:
        return root.rstrip("/")
    root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    root = tempfile.mkdtemp(prefix="metricspark-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, text: str):
    """A path of whatever file system the session knows, with that file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are removed at the end, as a batch of a stream
    needs. Nothing that reads them may be used afterwards."""
    folder = fresh_folder(spark, "scratch")
    token = _SCRATCH.set(folder)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        path, files = hadoop_path(spark, folder)
        files.delete(path, True)


def durable_path(df: DataFrame, name: str = "stage") -> str:
    """Write ``df`` once to the shared folder; where it is."""
    scratch_folder = _SCRATCH.get()
    path = f"{scratch_folder}/{name}-{uuid.uuid4().hex}" if scratch_folder else fresh_folder(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return path


def durable(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage so that a lost executor costs a re-read instead of a recompute,
    freezes values that depend on physical partitioning, and gives the optimizer true
    file sizes to choose its joins by.
    """
    return df.sparkSession.read.schema(df.schema).parquet(durable_path(df, name))


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Run independent steps as concurrent jobs of one session."""
    with ThreadPoolExecutor(len(steps)) as pool:
        done = [pool.submit(copy_context().run, inheritable_thread_target(spark)(step)) for step in steps]
        return [step.result() for step in done]
