"""Starting streaming queries."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from millrace.session import ROCKSDB_PROVIDER, scratch_path

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
DEFAULT_INTERVAL = "10 seconds"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB_PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    max_bytes: int | None = None,
) -> DataFrame:
    """Parquet files as a stream; ``max_bytes`` bounds each micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def start(
    writer: DataStreamWriter,
    spark: SparkSession,
    checkpoint: str,
    *,
    interval: str | None = DEFAULT_INTERVAL,
) -> StreamingQuery:
    """Starts a query that checkpoints to ``checkpoint``.

    With an ``interval`` it runs until stopped; with ``None`` it works off what is
    there, in as many micro-batches as the source's limits ask for, and ends.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    writer = (
        writer.trigger(availableNow=True)
        if interval is None
        else writer.trigger(processingTime=interval)
    )
    with rocksdb_state(spark):
        return writer.start()


def run_append(
    result: DataFrame, out: str, checkpoint: str, *, interval: str | None = None
) -> StreamingQuery:
    """Appends the final rows of a streaming result to Parquet files under ``out``."""
    writer = result.writeStream.outputMode("append").format("parquet")
    return start(
        writer.option("path", out), result.sparkSession, checkpoint, interval=interval
    )


def run_latest(
    result: DataFrame,
    out: str,
    checkpoint: str,
    mode: str,
    *,
    interval: str | None = None,
) -> StreamingQuery:
    """Writes what each micro-batch reports, for ``update`` or ``complete`` results.

    Micro-batch ``n`` owns the folder ``batch_id=n`` and overwrites it, so a repeated
    micro-batch leaves the same files.  Read them with :func:`latest_rows` or
    :func:`latest_batch`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = result.writeStream.outputMode(mode).foreachBatch(write)
    return start(writer, result.sparkSession, checkpoint, interval=interval)


def all_batches(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The rows of every micro-batch written so far."""
    return spark.read.schema(_with_batch_id(schema)).parquet(out).drop("batch_id")


def latest_rows(
    spark: SparkSession, out: str, schema: T.StructType, keys: list[str]
) -> DataFrame:
    """The newest row per key of an ``update`` result."""
    history = spark.read.schema(_with_batch_id(schema)).parquet(out)
    newest = history.groupBy(*keys).agg(
        F.max(F.struct("batch_id", *[n for n in schema.names if n not in keys])).alias(
            "_newest"
        )
    )
    return newest.select(
        *[name if name in keys else f"_newest.{name}" for name in schema.names]
    )


def latest_batch(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The rows of the last micro-batch of a ``complete`` result."""
    history = spark.read.schema(_with_batch_id(schema)).parquet(out)
    last = history.agg(F.max("batch_id")).first()[0]
    return history.where(F.col("batch_id") == last).drop("batch_id")


def _with_batch_id(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])


def appended(result: DataFrame, name: str) -> DataFrame:
    """Runs a bounded streaming result in append mode and reads back what it wrote."""
    spark = result.sparkSession
    base = scratch_path(spark, name)
    run_append(result, f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{base}/rows")


def completed(result: DataFrame, name: str) -> DataFrame:
    """Runs a bounded streaming result in complete mode and reads the last state."""
    spark = result.sparkSession
    base = scratch_path(spark, name)
    run_latest(
        result, f"{base}/rows", f"{base}/checkpoint", "complete"
    ).awaitTermination()
    return latest_batch(spark, f"{base}/rows", result.schema)


def updated(result: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Runs a bounded streaming result in update mode and reads the newest rows."""
    spark = result.sparkSession
    base = scratch_path(spark, name)
    run_latest(
        result, f"{base}/rows", f"{base}/checkpoint", "update"
    ).awaitTermination()
    return latest_rows(spark, f"{base}/rows", result.schema, keys)
