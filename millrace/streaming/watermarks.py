"""Watermarks, late rows and the watermark report."""

from __future__ import annotations

import json
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.session import scratch_path

REPORT_SCHEMA = "batch_id long, watermark string, input_rows long, late_rows long"


def with_watermark(df: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """Event time with bounded disorder: greatest time seen minus ``delay``.

    A timestamp without time zone becomes one in the session time zone first,
    because watermarks need it.  Spark moves the watermark between micro-batches,
    so a late row inside one micro-batch is not late yet.
    """
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)


def split_by_wall_clock(
    df: DataFrame, ts: str, lag: str, now: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows at most ``lag`` behind the clock, and the late rest.

    ``now`` replaces the clock, for a bounded input that must give the same result
    every time.  Null times count as late.
    """
    clock = F.current_timestamp() if now is None else now
    on_time = F.coalesce(F.col(ts) >= clock - F.expr(f"INTERVAL {lag}"), F.lit(False))
    return df.where(on_time), df.where(~on_time)


class WatermarkLog(StreamingQueryListener):
    """Keeps a row of every micro-batch of the queries that start while it listens.

    Spark itself remembers the last hundred reports of a query only.  Full pages of
    reports go to the shared folder, so the driver holds ``PAGE_ROWS`` rows of a query.
    """

    PAGE_ROWS = 10_000

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._rows: dict[str, list[tuple]] = {}
        self._pages: dict[str, list[str]] = {}
        self._ended: dict[str, threading.Event] = {}

    def __enter__(self) -> WatermarkLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        run, progress = str(event.progress.runId), json.loads(event.progress.json)
        rows = self._rows.setdefault(run, [])
        rows.append(_progress_row(progress))
        if len(rows) >= self.PAGE_ROWS:
            path = scratch_path(self._spark, "watermarks")
            self._spark.createDataFrame(rows, REPORT_SCHEMA).write.parquet(path)
            self._pages.setdefault(run, []).append(path)
            rows.clear()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def report(self, query: StreamingQuery, timeout: float = 60) -> DataFrame:
        """One row per micro-batch so far; all of them once the query has ended."""
        run = str(query.runId)
        if not query.isActive:
            ended = self._ended.setdefault(run, threading.Event())
            if not ended.wait(timeout):
                raise TimeoutError("the query's last report did not arrive")
        report = self._spark.createDataFrame(self._rows.get(run, []), REPORT_SCHEMA)
        for path in self._pages.get(run, []):
            report = report.unionByName(self._spark.read.parquet(path))
        return report.withColumn("watermark", F.to_timestamp("watermark"))


def _progress_row(progress) -> tuple:
    event_time = progress.get("eventTime") or {}
    operators = progress.get("stateOperators") or []
    return (
        int(progress["batchId"]),
        event_time.get("watermark"),
        int(progress["numInputRows"]),
        sum(int(operator["numRowsDroppedByWatermark"]) for operator in operators),
    )


def watermark_violations(report: DataFrame) -> DataFrame:
    """Pairs of successive micro-batches whose watermark went back.

    Micro-batches are numbered without gaps, so the earlier one is found by its number.
    """
    earlier = report.select(
        (F.col("batch_id") + 1).alias("batch_id"),
        F.col("watermark").alias("watermark_before"),
    )
    return report.join(earlier, "batch_id").where(
        F.col("watermark") < F.col("watermark_before")
    )


def check_watermarks(report: DataFrame, least_distinct: int = 1) -> DataFrame:
    """The report, after checking that watermarks never went back and did advance.

    ``least_distinct`` is the number of different watermarks the query must have
    shown by now; the first micro-batch shows the epoch.
    """
    if not watermark_violations(report).isEmpty():
        raise ValueError("a watermark went back")
    distinct = report.where(F.col("watermark").isNotNull()).agg(
        F.count_distinct("watermark")
    )
    seen = distinct.first()[0]
    if seen < least_distinct:
        raise ValueError(f"only {seen} different watermarks were seen")
    return report
