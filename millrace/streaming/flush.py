"""What a bounded run leaves open.

A stream in append mode reports a window once the watermark has passed its end.  When a
bounded input ends, its last windows are still in the query's state; here they are read from
there, so that closed and open windows together are those of the batch form.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.windows import WINDOW
from millrace.streaming.run import run_append


def last_batch(spark: SparkSession, folder: str) -> int:
    """Greatest micro-batch noted in a folder of the checkpoint, -1 without any."""
    names = spark.read.format("binaryFile").load(folder).select(
        F.regexp_extract("path", r"/(\d+)$", 1).alias("name")
    )
    return names.where("name <> ''").agg(
        F.coalesce(F.max(F.col("name").cast("long")), F.lit(-1))
    ).first()[0]


def check_finished(spark: SparkSession, checkpoint: str) -> None:
    """Fails unless the query's last micro-batch is committed.

    The sink may hold what an uncommitted one reported, while the state is that of the one
    before: its windows would come twice.
    """
    begun = last_batch(spark, f"{checkpoint}/offsets")
    done = last_batch(spark, f"{checkpoint}/commits")
    if begun != done:
        raise RuntimeError(
            f"micro-batch {begun} of {checkpoint} is unfinished: run the query to its end first"
        )


def open_windows(
    spark: SparkSession,
    checkpoint: str,
    keys: Sequence[str],
    values: Mapping[str, Column],
    *,
    operator_id: int = 0,
) -> DataFrame:
    """``window_start, window_end``, keys and values of the windows still in a query's state.

    The query has ended, and grouped by a window first and ``keys`` after it.  An aggregate
    keeps one or more buffers, in the order of the query's aggregates: ``values`` makes
    the results from them, as ``_0``, ``_1`` and so on.  Counts, sums, maxima
    and minima are their own buffer; a mean has a sum and a count.
    """
    check_finished(spark, checkpoint)
    state = spark.read.format("statestore").option("operatorId", operator_id).load(checkpoint)
    buffers = T.StructType(
        [
            T.StructField(f"_{place}", field.dataType)
            for place, field in enumerate(state.schema["value"].dataType)
        ]
    )
    return state.select(
        F.col(f"key.{WINDOW}.start").alias("window_start"),
        F.col(f"key.{WINDOW}.end").alias("window_end"),
        *[F.col("key")[name].alias(name) for name in keys],
        F.col("value").cast(buffers).alias("_buffers"),
    ).select(
        "window_start", "window_end", *keys, "_buffers.*"
    ).select(
        "window_start", "window_end", *keys, *[value.alias(name) for name, value in values.items()]
    )


def flush(
    result: DataFrame,
    out: str,
    checkpoint: str,
    keys: Sequence[str],
    values: Mapping[str, Column],
) -> DataFrame:
    """Closed windows, written by a query that has ended, and the open ones, written now.

    The open windows go to ``{out}-open`` and replace what an earlier flush left there, so
    a flush may be repeated, also after the query went on with more input.
    """
    spark = result.sparkSession
    left = open_windows(spark, checkpoint, keys, values)
    left.write.mode("overwrite").parquet(f"{out}-open")
    closed = spark.read.schema(result.schema).parquet(out)
    return closed.unionByName(spark.read.schema(result.schema).parquet(f"{out}-open"))


def run_to_the_end(
    result: DataFrame,
    out: str,
    checkpoint: str,
    keys: Sequence[str],
    values: Mapping[str, Column],
) -> DataFrame:
    """Works off a bounded stream of windows and returns all of them, the last included."""
    run_append(result, out, checkpoint).awaitTermination()
    return flush(result, out, checkpoint, keys, values)
