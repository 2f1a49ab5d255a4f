"""Tumbling windows on event time or processing time.

Windows are half open, ``[start, end)``, and aligned to the epoch unless ``start_time``
shifts them: in UTC for timestamps with time zone, as written for those without.  Everything here is a built-in
aggregate: rows are combined before the shuffle and no window is ever buffered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = "window"
_START = "_window_start"
_END = "_window_end"


def tumbling(
    df: DataFrame,
    ts: str,
    duration: str,
    keys: Sequence[str],
    aggregates: Mapping[str, Column],
    *,
    start_time: str | None = None,
) -> DataFrame:
    """Aggregates per window and key, with ``window_start`` and ``window_end``."""
    window = F.window(F.col(ts), duration, startTime=start_time).alias(WINDOW)
    named = [column.alias(name) for name, column in aggregates.items()]
    if df.isStreaming:
        # The watermark needs the window itself as grouping key.
        grouped = df.groupBy(window, *keys).agg(*named)
        start, end = F.col(f"{WINDOW}.start"), F.col(f"{WINDOW}.end")
    else:
        # One plain timestamp hashes and sorts faster than the pair.
        start, end = F.col(_START), F.col(_END)
        grouped = (
            df.select("*", window)
            .groupBy(F.col(f"{WINDOW}.start").alias(_START), *keys)
            .agg(F.max(f"{WINDOW}.end").alias(_END), *named)
        )
    return grouped.select(
        start.alias("window_start"), end.alias("window_end"), *keys, *aggregates
    )


def tumbling_count(
    df: DataFrame,
    ts: str,
    duration: str,
    keys: Sequence[str],
    out: str = "cnt",
    *,
    start_time: str | None = None,
) -> DataFrame:
    """Rows per window and key."""
    return tumbling(
        df, ts, duration, keys, {out: F.count(F.lit(1))}, start_time=start_time
    )


def arg_max_struct(by: str, seq: str, payload: Sequence[str]) -> Column:
    """The row with the greatest ``by``; among equals, the one with the least ``seq``."""
    return F.max(
        F.struct(
            F.col(by).alias("by"),
            (-F.col(seq)).alias("back_seq"),
            *[F.col(name) for name in payload],
        )
    )


def tumbling_arg_max(
    df: DataFrame,
    ts: str,
    duration: str,
    by: str,
    seq: str,
    payload: Sequence[str],
    keys: Sequence[str] = (),
    *,
    start_time: str | None = None,
) -> DataFrame:
    """The winning row of each window (and key, if any): greatest ``by``, earliest ``seq``.

    Without keys this is the global window: each task reduces its own rows first
    and one row per task and window crosses the shuffle.
    """
    best = tumbling(
        df,
        ts,
        duration,
        keys,
        {"best": arg_max_struct(by, seq, payload)},
        start_time=start_time,
    )
    return best.select(
        "window_start",
        "window_end",
        *keys,
        F.col("best.by").alias(by),
        (-F.col("best.back_seq")).alias(seq),
        *[F.col(f"best.{name}").alias(name) for name in payload],
    )


def with_processing_time(df: DataFrame, out: str = "processing_time") -> DataFrame:
    """Adds the time of processing; all rows of one micro-batch share one value."""
    return df.withColumn(out, F.current_timestamp())


def processing_time_sum(
    df: DataFrame, duration: str, keys: Sequence[str], value: Column, out: str
) -> DataFrame:
    """Sum per processing-time window and key; stream it in ``update`` mode."""
    return tumbling(
        with_processing_time(df), "processing_time", duration, keys, {out: F.sum(value)}
    )
