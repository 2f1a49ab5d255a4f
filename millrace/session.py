"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

SHUFFLE_PARTITION_BYTES = 256 << 20
MIN_PARTITIONS = 8
MAX_PARTITIONS = 100_000

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints of tables go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # Checkpoint the changes of a micro-batch instead of whole state files.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def session_builder(
    app_name: str, input_bytes: int | None = None
) -> SparkSession.Builder:
    """A builder carrying the library's defaults; the master stays the caller's.

    ``input_bytes``, the size of the largest shuffled input, sets the number of
    shuffle partitions.  Adaptive execution joins small ones but adds none, so the
    number has to fit the largest shuffle.  A stream keeps the number it first ran
    with: size it by its micro-batches.
    """
    builder = SparkSession.builder.appName(app_name)
    for name, value in DEFAULTS.items():
        builder = builder.config(name, value)
    if input_bytes is not None:
        partitions = shuffle_partitions(input_bytes)
        builder = builder.config("spark.sql.shuffle.partitions", partitions)
    return builder


def shuffle_partitions(input_bytes: int) -> int:
    """Enough partitions that one sorts in memory, within what a driver can track."""
    needed = -(-input_bytes // SHUFFLE_PARTITION_BYTES)
    return min(max(needed, MIN_PARTITIONS), MAX_PARTITIONS)


def is_local(spark: SparkSession) -> bool:
    """True when every task runs inside the driver's own process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A machine-local folder is created only in local mode and only when the
    setting is absent; on a cluster its absence is an error, because executors
    could not read each other's files.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        if not is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir must name a folder every executor can reach"
            )
        root = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", root)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder under the shared folder, if it is there."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
