"""Windows on a stream with a second output for rows that come too late.

Spark's own windowed aggregates drop a late row and count it.  Here each micro-batch is a table
step: rows whose window was closed by an earlier micro-batch go to the late output as
they are, all others into partial windows, which are carried until the watermark passes
their end.  On-time and late rows together are the input.

Micro-batch ``n`` writes ``batch_id=n`` under both outputs and one of two slots of what is
carried, the other slot is what it read: repeating it gives the same files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.streaming.flush import check_finished, last_batch
from millrace.streaming.run import start

WATERMARK = "_watermark"
CLOSED = "closed"
LATE = "late"
_AGAIN = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}
_FIRST = {**_AGAIN, "count": F.count}


@dataclass(frozen=True)
class Part:
    """A mergeable aggregate: ``how`` is ``count``, ``sum``, ``max`` or ``min`` of ``value``."""

    how: str
    value: Column


def _slot(checkpoint: str, batch_id: int) -> str:
    return f"{checkpoint}/carried/{batch_id % 2}"


def _windowed(df: DataFrame, ts: str, duration: str) -> DataFrame:
    window = F.window(F.col(ts), duration)
    return df.select("*", window.start.alias("window_start"), window.end.alias("window_end"))


def window_schema(
    stream: DataFrame, ts: str, duration: str, keys: Sequence[str], parts: Mapping[str, Part]
) -> T.StructType:
    """Of the windows that :func:`run_windows` reports and carries."""
    fields = (
        _windowed(stream, ts, duration)
        .groupBy("window_start", "window_end", *keys)
        .agg(*[_FIRST[part.how](part.value).alias(name) for name, part in parts.items()])
        .schema.fields
    )
    return T.StructType([T.StructField(field.name, field.dataType) for field in fields])


def run_windows(
    stream: DataFrame,
    ts: str,
    duration: str,
    keys: Sequence[str],
    parts: Mapping[str, Part],
    delay: str,
    out: str,
    checkpoint: str,
    *,
    interval: str | None = None,
) -> StreamingQuery:
    """Closed windows under ``{out}/closed``, late rows under ``{out}/late``.

    The watermark is the greatest ``ts`` of the micro-batches so far minus ``delay``.  A
    row is late if its window's end was at or behind the watermark when its
    micro-batch began.  A row without time belongs to no window and is late, too.
    """
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    schema = window_schema(stream, ts, duration, keys, parts)
    names = ["window_start", "window_end", *keys]
    moment = T.StructType([T.StructField(WATERMARK, T.TimestampType())])

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id:
            before = spark.read.schema(schema).parquet(f"{_slot(checkpoint, batch_id - 1)}/windows")
            passed = spark.read.schema(moment).parquet(f"{_slot(checkpoint, batch_id - 1)}/watermark")
            watermark = passed.first()[0]
        else:
            before, watermark = spark.createDataFrame([], schema), None
        rows = batch.persist()
        try:
            newest = rows.agg(F.max(ts) - F.expr(f"INTERVAL {delay}")).first()[0]
            after = max((w for w in (watermark, newest) if w is not None), default=None)
            behind = F.lit(False) if watermark is None else F.col("window_end") <= F.lit(watermark)
            # A generated window drops rows without time: they are added to the late ones.
            placed = _windowed(rows, ts, duration)
            late = placed.where(behind).select(*rows.columns).unionByName(rows.where(F.col(ts).isNull()))
            partial = (
                placed.where(~behind)
                .groupBy(*names)
                .agg(*[_FIRST[part.how](part.value).alias(name) for name, part in parts.items()])
            )
            merged = (
                partial.unionByName(before)
                .groupBy(*names)
                .agg(*[_AGAIN[part.how](name).cast(schema[name].dataType).alias(name) for name, part in parts.items()])
                .persist()
            )
            done = F.lit(False) if after is None else F.col("window_end") <= F.lit(after)
            late.write.mode("overwrite").parquet(f"{out}/{LATE}/batch_id={batch_id}")
            merged.where(done).write.mode("overwrite").parquet(f"{out}/{CLOSED}/batch_id={batch_id}")
            slot = _slot(checkpoint, batch_id)
            merged.where(~done).write.mode("overwrite").parquet(f"{slot}/windows")
            spark.createDataFrame([(after,)], moment).write.mode("overwrite").parquet(f"{slot}/watermark")
            merged.unpersist()
        finally:
            rows.unpersist()

    writer = stream.writeStream.outputMode("append").foreachBatch(process)
    return start(writer, stream.sparkSession, checkpoint, interval=interval)


def late_rows(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The second output of :func:`run_windows`; ``schema`` is the stream's."""
    return spark.read.schema(schema).parquet(f"{out}/{LATE}").select(*schema.names)


def closed_windows(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{out}/{CLOSED}").select(*schema.names)


def open_windows(spark: SparkSession, checkpoint: str, schema: T.StructType) -> DataFrame:
    """The windows that the last micro-batch of a query that has ended left open."""
    check_finished(spark, checkpoint)
    last = last_batch(spark, f"{checkpoint}/commits")
    return spark.read.schema(schema).parquet(f"{_slot(checkpoint, last)}/windows")
