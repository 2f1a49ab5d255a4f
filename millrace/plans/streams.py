"""Streaming queries over the events, run to the end of what is there."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import parse, relational, windows
from millrace.plans import batch, tables
from millrace.session import scratch_path
from millrace.sinks.files import rolling_text
from millrace.streaming.microbatch import (
    run_changelog_count,
    run_count_windows,
    run_pattern_matches,
)
from millrace.streaming.run import (
    all_batches,
    appended,
    completed,
    run_append,
    stream_parquet,
    updated,
)
from millrace.streaming.stateful import (
    stream_changelog_count,
    stream_count_windows,
    stream_pattern_matches,
)
from millrace.streaming.watermarks import WatermarkLog, check_watermarks, with_watermark

# A key's share of one micro-batch meets in one task of the stateful operations.
STATEFUL_BATCH = 1 << 28
# The table steps split such a key, so a backlog may be worked off in large pieces.
BACKLOG_BATCH = 1 << 40


def events_stream(
    spark: SparkSession, sf_dir: str, max_bytes: int | None = None
) -> DataFrame:
    # The braces make it a pattern: it names one file as well as a folder of files,
    # while a plain path would have to be a folder.
    path = tables.path(sf_dir, "{events}")
    return stream_parquet(spark, path, tables.schema("events"), max_bytes=max_bytes)


def _ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def stream_tumble_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_watermark(events_stream(spark, sf_dir), "ts", "10 seconds")
    counts = windows.tumbling_count(events, "ts", "1 hour", ["user_id"])
    return _ntz(appended(counts, "tumble-closed"), "window_start", "window_end")


def stream_multi_agg_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_watermark(events_stream(spark, sf_dir), "ts", "0 seconds")
    price = F.col("value").cast("decimal(10,2)")
    result = windows.tumbling(
        events,
        "ts",
        "5 minutes",
        [],
        {
            "max_ts": F.max("ts"),
            "counter": F.count(F.lit(1)),
            "total_price": F.max(price).cast("double"),
        },
    ).drop("window_start")
    return _ntz(appended(result, "multi-agg-closed"), "window_end", "max_ts")


def stream_argmax_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = windows.tumbling_arg_max(
        events_stream(spark, sf_dir), "ts", "1 hour", "value", "event_id", ["user_id"]
    )
    return completed(best, "argmax")


def stream_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = relational.grouped_count(
        events_stream(spark, sf_dir), ["user_id"], "cnt", "event_type"
    )
    return updated(counts, "running-count", ["user_id"])


def stream_edit_size_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_watermark(
        batch.edits(events_stream(spark, sf_dir)), "ts", "1 second"
    )
    sums = windows.tumbling(
        rows, "ts", "5 seconds", ["user_id"], {"byte_diff": F.sum("byte_diff")}
    ).drop("window_start")
    latest = updated(sums, "edit-size", ["window_end", "user_id"])
    return _ntz(latest, "window_end")


def stream_processing_time_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = windows.processing_time_sum(
        events_stream(spark, sf_dir), "3 seconds", ["event_type"], F.lit(1), "frequency"
    )
    latest = updated(
        sums, "processing-time", ["window_start", "window_end", "event_type"]
    )
    # Which window a row met depends on the clock; the total per word does not.
    return relational.grouped_sum(latest, ["event_type"], "frequency", "frequency")


def stream_union_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["event_id", "user_id", "value"]
    events = events_stream(spark, sf_dir).select(*columns)
    again = events_stream(spark, sf_dir).select(*columns)
    both = relational.union_filtered(
        events, F.col("value") > 10, again, F.col("value") < 2
    )
    return appended(both, "union")


def _per_batch(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    begin: Callable[[str, str], StreamingQuery],
) -> DataFrame:
    base = scratch_path(spark, name)
    begin(f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    return all_batches(spark, f"{base}/rows", schema)


def stream_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("is_add", T.BooleanType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("cnt", T.LongType()),
            T.StructField("event_id", T.LongType()),
        ]
    )
    return _per_batch(
        spark,
        "changelog",
        schema,
        lambda out, checkpoint: run_changelog_count(
            events_stream(spark, sf_dir, BACKLOG_BATCH),
            ["user_id"],
            ["event_id"],
            "event_type",
            out,
            checkpoint,
        ),
    )


def stream_count_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = events_stream(spark, sf_dir, BACKLOG_BATCH).select(
        "user_id", "event_id", batch.whole("value").alias("score")
    )
    return _stepped_windows(spark, scores)


def stream_count_window_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = batch.gappy(events_stream(spark, sf_dir, BACKLOG_BATCH))
    found = _stepped_windows(spark, scores)
    return found.withColumn("total", F.col("total").cast("double"))


def stateful_count_window_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = batch.gappy(events_stream(spark, sf_dir, STATEFUL_BATCH))
    found = appended(
        stream_count_windows(scores, ["user_id"], ["event_id"], 2, "score"),
        "stateful-count-window-nulls",
    )
    return found.withColumn("total", F.col("total").cast("double"))


def _stepped_windows(spark: SparkSession, scores: DataFrame) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("user_id", T.LongType()),
            T.StructField("window_index", T.LongType()),
            T.StructField("total", T.LongType()),
            T.StructField("mean", T.DoubleType()),
        ]
    )
    return _per_batch(
        spark,
        "count-window",
        schema,
        lambda out, checkpoint: run_count_windows(
            scores, ["user_id"], ["event_id"], 2, "score", out, checkpoint
        ),
    )


def stream_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = T.StructType([T.StructField("event_id", T.LongType())])
    schema = T.StructType(
        [
            T.StructField("user_id", T.LongType()),
            *[T.StructField(stage, event) for stage in batch.FUNNEL],
        ]
    )
    found = _per_batch(
        spark,
        "pattern",
        schema,
        lambda out, checkpoint: run_pattern_matches(
            events_stream(spark, sf_dir, BACKLOG_BATCH),
            ["user_id"],
            ["ts", "event_id"],
            batch.funnel_stages(),
            ["event_id"],
            batch.ONE_DAY,
            timedelta(days=1),
            out,
            checkpoint,
        ),
    )
    return found.select(
        "user_id",
        *[F.col(f"{stage}.event_id").alias(f"{stage}_id") for stage in batch.FUNNEL],
    )


def stateful_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_stream(spark, sf_dir, STATEFUL_BATCH)
    changes = stream_changelog_count(events, ["user_id"], ["event_id"], "event_type")
    return appended(changes, "stateful-changelog")


def stateful_count_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_stream(spark, sf_dir, STATEFUL_BATCH).select(
        "user_id", "event_id", batch.whole("value").alias("score")
    )
    return appended(
        stream_count_windows(events, ["user_id"], ["event_id"], 2, "score"),
        "stateful-count-window",
    )


def stateful_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = stream_pattern_matches(
        events_stream(spark, sf_dir, STATEFUL_BATCH),
        ["user_id"],
        ["ts", "event_id"],
        batch.funnel_stages(),
        ["event_id"],
        within=batch.ONE_DAY,
        lateness=timedelta(days=1),
    )
    found = appended(matches, "stateful-pattern")
    return found.select(
        "user_id",
        *[F.col(f"{stage}_event_id").alias(f"{stage}_id") for stage in batch.FUNNEL],
    )


def stream_parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = batch.click_lines(events_stream(spark, sf_dir))
    clicks = parse.parse_click_lines(lines, batch.BASE_DATE)
    return _ntz(appended(clicks, "parsed-lines"), "timestamp")


def rolling_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "rolling")
    line = F.concat_ws(" ", F.col("user_id").cast("string"), "event_type", "props")
    query = rolling_text(
        events_stream(spark, sf_dir),
        line,
        f"{base}/lines",
        f"{base}/checkpoint",
        interval=None,
        max_records_per_file=5_000_000,
    )
    query.awaitTermination()
    written = spark.read.schema("value string, bucket string").text(f"{base}/lines")
    return written.select(F.col("value").alias("line"))


def watermark_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "audit")
    events = with_watermark(events_stream(spark, sf_dir), "ts", "10 seconds")
    counts = windows.tumbling_count(events, "ts", "1 day", ["event_type"])
    with WatermarkLog(spark) as log:
        query = run_append(counts, f"{base}/rows", f"{base}/checkpoint")
        query.awaitTermination()
        report = check_watermarks(log.report(query))
    return report.agg(
        F.max("watermark").cast("timestamp_ntz").alias("last_watermark"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows").alias("late_rows"),
    )


QUERIES = {
    function.__name__: function
    for function in (
        stream_tumble_closed,
        stream_multi_agg_closed,
        stream_argmax_complete,
        stream_running_count,
        stream_edit_size_5s,
        stream_processing_time_sum,
        stream_union_filtered,
        stream_changelog,
        stream_count_window,
        stream_count_window_nulls,
        stateful_count_window_nulls,
        stream_pattern,
        stateful_changelog,
        stateful_count_window,
        stateful_pattern,
        stream_parsed_lines,
        rolling_sink,
        watermark_audit,
    )
}

ORACLES = {
    "stream_tumble_closed": f"""
        SELECT * FROM ({batch.ORACLES["tumble_count_user_1h"]})
        WHERE window_end <= (SELECT max(ts) - INTERVAL '10 seconds' FROM events)""",
    "stream_multi_agg_closed": """
        SELECT time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes'
                 AS window_end,
               max(ts) AS max_ts, count(*) AS counter,
               CAST(max(CAST(value AS DECIMAL(10, 2))) AS DOUBLE) AS total_price
        FROM events GROUP BY 1
        HAVING time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes'
                 <= (SELECT max(ts) FROM events)""",
    "stream_argmax_complete": batch.ORACLES["window_argmax_1h"],
    "stream_running_count": """
        SELECT user_id, count(event_type) AS cnt FROM events GROUP BY user_id""",
    "stream_edit_size_5s": batch.ORACLES["edit_size_user_5s"],
    "stream_processing_time_sum": """
        SELECT event_type, count(*) AS frequency FROM events GROUP BY event_type""",
    "stream_union_filtered": """
        SELECT event_id, user_id, value FROM events WHERE value > 10
        UNION ALL
        SELECT event_id, user_id, value FROM events WHERE value < 2""",
    "stream_changelog": batch.ORACLES["changelog_count_user"],
    "stateful_count_window": batch.ORACLES["count_window_2"],
    "stateful_pattern": batch.ORACLES["pattern_signup_view_purchase_1d"],
    "stateful_changelog": f"""
        SELECT is_add, user_id, cnt FROM ({batch.ORACLES["changelog_count_user"]})""",
    "stream_count_window": batch.ORACLES["count_window_2"],
    "stream_count_window_nulls": batch.ORACLES["count_window_nulls"],
    "stateful_count_window_nulls": batch.ORACLES["count_window_nulls"],
    "stream_pattern": batch.ORACLES["pattern_signup_view_purchase_1d"],
    "stream_parsed_lines": batch.ORACLES["parsed_lines"],
    "rolling_sink": """
        SELECT user_id || ' ' || event_type || ' ' || props AS line FROM events""",
    "watermark_audit": """
        SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '10 seconds'
                 AS last_watermark,
               count(*) AS input_rows, CAST(0 AS BIGINT) AS late_rows
        FROM events""",
}
