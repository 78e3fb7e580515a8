"""Session settings the jobs count on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings only, so they can be applied to a session someone else built.
#
# * Skew: a hot customer or product ends up in one shuffle partition of a sort-merge join; the adaptive
#   skew join splits that partition over many tasks. It is forced because the fact join is followed by an
#   aggregation that reuses its partitioning, and Spark would otherwise give up the split to keep the reuse.
# * State: receipts seen by a stream are remembered on disk rather than on the heap.
#   Commits upload the new files of the store and no log of its changes beside them: a large micro-batch would be kept twice.
#   These files are compressed, rows are not counted at every write, and the four stores of a
#   join of two streams are one with four column families. A checkpoint begun otherwise goes on as it was.
# * Files: Parquet tables, intermediate ones too, are compressed more than by default.
# * Time zone: receipts keep their wall clock as TIMESTAMP_NTZ; streaming watermarks need TIMESTAMP, and the
#   two only agree day by day when the session zone is UTC.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


# Shuffled data that one task should hold.
BYTES_PER_TASK = 200 * 1024**2


def tune(spark: SparkSession, largest_shuffle: int | None = None) -> SparkSession:
    """Apply the runtime settings above to a running session and return it.

    With the size in bytes of the largest expected shuffle, the number of shuffle partitions is raised so that
    each fits a task; adaptive execution merges them again where a shuffle is smaller.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if largest_shuffle is not None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        needed = -(-largest_shuffle // BYTES_PER_TASK)
        spark.conf.set("spark.sql.shuffle.partitions", str(max(partitions, needed)))
    return spark


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs that write inside remove what they shuffled as soon as they end, and not when the driver happens to collect its garbage.

    A write runs its own plan, so no later job wants these files.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for one machine (tests, benchmark). A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillmart")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    return tune(builder.getOrCreate())


def checkpoint_root(spark: SparkSession) -> str:
    """The folder all executors share, taken from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a fresh temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        root = tempfile.mkdtemp(prefix="tillmart-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
