"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where the next step then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Rows that carry sample arrays go to Python workers in batches of tens of megabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Streaming keys are kept off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "fathomgrid", master: str | None = None, **extra: str) -> SparkSession:
    """Create a session; `extra` holds further settings such as memory or shuffle partitions."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All instants are UTC; text and epoch conversions rely on the session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_TURN = threading.RLock()


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session has these settings within; its own are put back. Threads that share a session take turns, or one
    would put back what another still needs."""
    with _TURN:
        before = {key: spark.conf.get(key, None) for key in values}
        for key, value in values.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)


STATE_PARTITIONS = 8
STATE = {
    "spark.sql.streaming.stateStore.providerClass": SETTINGS["spark.sql.streaming.stateStore.providerClass"],
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # All stores of an executor share one cache and one budget for what is not yet written.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # A join of streams keeps its four tables in one store.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # Counting a store's rows asks for each key before it is written.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # Checksum files take each store four threads, and a second file for every file.
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
    # Stores of ended queries are closed at the next round of maintenance.
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}
"""An open store holds files, threads and memory of its process, also after its query has ended: with many of them
a process comes to its limits, such as 1,024 open files."""


def keyed_state(spark: SparkSession):
    """Streams started within keep their state in RocksDB, whatever the session names: processors with state of their
    own run on no other store.

    A batch commits every store of every partition, however few rows it brought, so a new query deals its state to no
    more partitions than keep the cores busy, and commits what changed instead of a copy of the whole store. A query
    with a checkpoint keeps the number of partitions it began with.
    """
    parts = "spark.sql.shuffle.partitions"
    most = max(STATE_PARTITIONS, 2 * spark.sparkContext.defaultParallelism)
    return _settings(spark, {**STATE, parts: str(min(int(spark.conf.get(parts)), most))})


LISTING_TASKS = 32


def few_listing_tasks(spark: SparkSession):
    """Readers made within list their folders in few tasks. By default a folder is a task, up to 10,000 for each parent
    folder, and a task's own report to the driver is several times what it lists."""
    return _settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(LISTING_TASKS)})


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    A local folder is taken only where the session names none and runs on one machine; it goes with
    the process.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", ""
    )
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="fathomgrid-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, and of a size that the planner knows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reliable(df: DataFrame) -> DataFrame:
    """Cut lineage with a checkpoint in the shared folder, which outlives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
