"""Session factory and the one shared folder jobs may write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

APP_NAME = "aeroline"

# Only semantics live here. Executor counts, memory and shuffle partitions belong to spark-submit: they depend on
# the cluster and the data, and adaptive execution merges shuffle partitions that turn out small.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state on local disk with checkpointed changes instead of on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_own_folders: dict[str, str] = {}
_scratch: ContextVar[str] = ContextVar("scratch", default="")


def create_session(app_name: str = APP_NAME, master: str | None = None, overrides: dict | None = None) -> SparkSession:
    """A new or existing session with the job defaults; ``overrides`` win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(overrides or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def get_or_create_session(app_name: str = APP_NAME) -> SparkSession:
    return SparkSession.getActiveSession() or create_session(app_name)


def stop_session(spark: SparkSession | None) -> None:
    if spark is not None:
        spark.stop()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables (``spark.checkpoint.dir``).

    Only a local master may fall back to a folder of its own: on a cluster a machine-local folder would lose data
    together with the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _own_folders.setdefault(context.applicationId, tempfile.mkdtemp(prefix="aeroline-"))


def work_folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_folder(spark)}/aeroline/{spark.sparkContext.applicationId}{_scratch.get()}"


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the work folder."""
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back as a table.

    Cuts the lineage in a way that survives lost executors, and gives the optimizer the true size: a staged
    dimension is broadcast only if its files are below ``spark.sql.autoBroadcastJoinThreshold``; a larger one is
    joined by shuffling. Jobs drop their work folder at the end, see :func:`clear_work`.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_once(actions: list[Callable[[], object]]) -> list:
    """Run independent small jobs concurrently, so the cluster is not idle between them; the first error is raised."""
    with ThreadPoolExecutor(max_workers=max(1, len(actions))) as pool:
        return [future.result() for future in [pool.submit(action) for action in actions]]


def remove_path(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside, by this thread, is dropped at the end: a stream keeps no copy of every batch."""
    token = _scratch.set(f"{_scratch.get()}/scratch-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        remove_path(spark, work_folder(spark))
        _scratch.reset(token)


def clear_work(spark: SparkSession) -> None:
    """Drop what this application has staged; call it when no result is read any more."""
    remove_path(spark, work_folder(spark))
