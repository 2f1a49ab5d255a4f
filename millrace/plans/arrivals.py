"""Streaming queries over events that arrive in parts, with a restart after each.

Each part is a folder of files.  A query works off what is there and ends, and goes on from its
checkpoint when the next part has arrived: what it carries crosses micro-batches and runs.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import windows
from millrace.plans import batch, streams, tables
from millrace.session import scratch_path
from millrace.sinks.rolling import rolling_files
from millrace.streaming import late
from millrace.streaming.flush import flush, run_to_the_end
from millrace.streaming.microbatch import run_changelog_count, run_count_windows, run_pattern_matches
from millrace.streaming.run import all_batches, appended, run_append, stream_parquet
from millrace.streaming.stateful import stream_changelog_count, stream_count_windows, stream_pattern_matches
from millrace.streaming.watermarks import with_watermark

PARTS = 3
ROLL_BYTES = 1 << 20
STRAGGLERS = 7  # every so many rows one arrives a part later


def in_parts(
    spark: SparkSession,
    sf_dir: str,
    begin: Callable[[DataFrame], StreamingQuery],
    part_of: Callable[[Column], Column] = lambda part: part,
) -> list[StreamingQuery]:
    """Starts ``begin`` after each part of the events, which are in order of their ids.

    ``part_of`` moves rows to other parts than those their ids give.
    """
    base = scratch_path(spark, "arrivals")
    events = tables.table(spark, sf_dir, "events")
    low, high = events.agg(F.coalesce(F.min("event_id"), F.lit(0)), F.coalesce(F.max("event_id"), F.lit(0))).first()
    size = (high - low) // PARTS + 1
    part = part_of(F.floor((F.col("event_id") - low) / size).cast("int"))
    queries = []
    for number in range(PARTS):
        arrived = events.where(part == number)
        arrived.write.parquet(f"{base}/part={number}")
        stream = stream_parquet(spark, f"{base}/part=*", tables.schema("events"))
        queries.append(begin(stream))
        queries[-1].awaitTermination()
    return queries


def parts_tumble_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows of three runs and the windows left open at the end."""
    base = scratch_path(spark, "parts-tumble")
    counts = None

    def begin(stream: DataFrame) -> StreamingQuery:
        nonlocal counts
        counts = windows.tumbling_count(with_watermark(stream, "ts", "10 seconds"), "ts", "1 hour", ["user_id"])
        return run_append(counts, f"{base}/rows", f"{base}/checkpoint")

    in_parts(spark, sf_dir, begin)
    found = flush(counts, f"{base}/rows", f"{base}/checkpoint", ["user_id"], {"cnt": F.col("_0")})
    return streams._ntz(found, "window_start", "window_end")


def _best(events: DataFrame) -> DataFrame:
    events = with_watermark(events, "ts", "3 seconds")
    return windows.tumbling_arg_max(events, "ts", "1 hour", "value", "event_id", ["user_id"])


def stream_argmax_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winner of each window as soon as the window is closed, reported once."""
    best = _best(streams.events_stream(spark, sf_dir))
    return streams._ntz(appended(best, "argmax-closed"), "window_start", "window_end")


def stream_argmax_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closed windows, and at the end of the input the open ones."""
    base = scratch_path(spark, "argmax-all")
    winner = {
        "value": F.col("_0.by"),
        "event_id": -F.col("_0.back_seq"),
        "user_id": F.col("_0.user_id"),
    }
    best = _best(streams.events_stream(spark, sf_dir))
    found = run_to_the_end(best, f"{base}/rows", f"{base}/checkpoint", [], winner)
    return streams._ntz(found, "window_start", "window_end")


def stream_multi_agg_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several aggregates per window, the last windows included."""
    base = scratch_path(spark, "multi-all")
    events = with_watermark(streams.events_stream(spark, sf_dir), "ts", "0 seconds")
    result = windows.tumbling(
        events,
        "ts",
        "5 minutes",
        [],
        {"max_ts": F.max("ts"), "counter": F.count(F.lit(1)), "mean_value": F.avg("value")},
    )
    values = {"max_ts": F.col("_0"), "counter": F.col("_1"), "mean_value": F.col("_2") / F.col("_3")}
    found = run_to_the_end(result, f"{base}/rows", f"{base}/checkpoint", [], values)
    # Sums of doubles differ in their last digits by the order of the rows.
    found = found.withColumn("mean_value", F.round("mean_value", 6))
    return streams._ntz(found, "window_start", "window_end", "max_ts")


def _straggling(part: Column) -> Column:
    late_by_one = (F.col("event_id") % STRAGGLERS == 0).cast("int")
    return F.least(part + late_by_one, F.lit(PARTS - 1))


def _late_run(spark: SparkSession, sf_dir: str):
    base = scratch_path(spark, "late")
    parts = {"cnt": late.Part("count", F.lit(1)), "total": late.Part("sum", batch.whole("value"))}
    schema: dict = {}

    def begin(stream: DataFrame) -> StreamingQuery:
        rows = stream.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
        schema["rows"] = rows.schema
        schema["windows"] = late.window_schema(rows, "ts", "6 hours", ["event_type"], parts)
        return late.run_windows(
            rows, "ts", "6 hours", ["event_type"], parts, "10 seconds", f"{base}/rows", f"{base}/checkpoint"
        )

    in_parts(spark, sf_dir, begin, _straggling)
    return base, schema


def parts_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose window was closed when they arrived."""
    base, schema = _late_run(spark, sf_dir)
    rows = late.late_rows(spark, f"{base}/rows", schema["rows"])
    return streams._ntz(rows.select("event_id", "ts", "event_type"), "ts")


def parts_on_time_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the rows that arrived in time, closed or still open at the end."""
    base, schema = _late_run(spark, sf_dir)
    found = late.closed_windows(spark, f"{base}/rows", schema["windows"]).unionByName(
        late.open_windows(spark, f"{base}/checkpoint", schema["windows"])
    )
    return streams._ntz(found, "window_start", "window_end")


def _stepped(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType, begin) -> DataFrame:
    base = scratch_path(spark, name)
    in_parts(spark, sf_dir, lambda stream: begin(stream, f"{base}/rows", f"{base}/checkpoint"))
    return all_batches(spark, f"{base}/rows", schema)


def parts_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stepped(
        spark,
        sf_dir,
        "parts-changelog",
        T.StructType.fromDDL("is_add boolean, user_id long, cnt long, event_id long"),
        lambda stream, out, checkpoint: run_changelog_count(
            stream, ["user_id"], ["event_id"], "event_type", out, checkpoint
        ),
    )


def _scores(stream: DataFrame) -> DataFrame:
    return stream.select("user_id", "event_id", batch.whole("value").alias("score"))


def parts_count_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stepped(
        spark,
        sf_dir,
        "parts-count-window",
        T.StructType.fromDDL("user_id long, window_index long, total long, mean double"),
        lambda stream, out, checkpoint: run_count_windows(
            _scores(stream), ["user_id"], ["event_id"], 2, "score", out, checkpoint
        ),
    )


def parts_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = ", ".join(f"{stage} struct<event_id: long>" for stage in batch.FUNNEL)
    found = _stepped(
        spark,
        sf_dir,
        "parts-pattern",
        T.StructType.fromDDL(f"user_id long, {stages}"),
        lambda stream, out, checkpoint: run_pattern_matches(
            stream,
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
    return found.select("user_id", *[F.col(f"{stage}.event_id").alias(f"{stage}_id") for stage in batch.FUNNEL])


def _stateful(spark: SparkSession, sf_dir: str, name: str, result_of) -> DataFrame:
    base = scratch_path(spark, name)
    schema = None

    def begin(stream: DataFrame) -> StreamingQuery:
        nonlocal schema
        result = result_of(stream)
        schema = result.schema
        return run_append(result, f"{base}/rows", f"{base}/checkpoint")

    in_parts(spark, sf_dir, begin)
    return spark.read.schema(schema).parquet(f"{base}/rows")


def parts_stateful_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stateful(
        spark,
        sf_dir,
        "parts-stateful-changelog",
        lambda stream: stream_changelog_count(stream, ["user_id"], ["event_id"], "event_type"),
    )


def parts_stateful_count_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stateful(
        spark,
        sf_dir,
        "parts-stateful-count-window",
        lambda stream: stream_count_windows(_scores(stream), ["user_id"], ["event_id"], 2, "score"),
    )


def parts_stateful_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _stateful(
        spark,
        sf_dir,
        "parts-stateful-pattern",
        lambda stream: stream_pattern_matches(
            stream,
            ["user_id"],
            ["ts", "event_id"],
            batch.funnel_stages(),
            ["event_id"],
            within=batch.ONE_DAY,
            lateness=timedelta(days=1),
        ),
    )
    return found.select("user_id", *[F.col(f"{stage}_event_id").alias(f"{stage}_id") for stage in batch.FUNNEL])


def _rolled(spark: SparkSession, base: str) -> DataFrame:
    """The lines under ``base``, and whether the file of each keeps to ``ROLL_BYTES``."""
    lines = spark.read.schema("value string, bucket string").text(f"{base}/lines")
    return lines.select(F.col("value").alias("line"), (F.col("_metadata.file_size") <= ROLL_BYTES).alias("fits"))


def rolling_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of three runs in files that roll by bytes, a folder for each type of event."""
    base = scratch_path(spark, "rolling-bytes")
    line = F.concat_ws(" ", F.col("user_id").cast("string"), "event_type", "props")

    def begin(stream: DataFrame) -> StreamingQuery:
        return rolling_files(
            stream,
            line,
            f"{base}/lines",
            f"{base}/checkpoint",
            interval=None,
            max_bytes=ROLL_BYTES,
            bucket=F.col("event_type"),
        )

    in_parts(spark, sf_dir, begin)
    return _rolled(spark, base)


def rolling_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of a count, as lines in folders named by the hour, rolled by bytes."""
    base = scratch_path(spark, "rolling-changelog")
    line = F.concat_ws(",", F.col("is_add").cast("string"), F.col("user_id").cast("string"), F.col("cnt").cast("string"))

    def begin(stream: DataFrame) -> StreamingQuery:
        changes = stream_changelog_count(stream, ["user_id"], ["event_id"], "event_type")
        return rolling_files(
            changes,
            line,
            f"{base}/lines",
            f"{base}/checkpoint",
            interval=None,
            max_bytes=ROLL_BYTES,
            prefix="changes",
        )

    in_parts(spark, sf_dir, begin)
    return _rolled(spark, base)


QUERIES = {
    function.__name__: function
    for function in (
        parts_tumble_all,
        stream_argmax_closed,
        stream_argmax_all,
        stream_multi_agg_all,
        parts_late_rows,
        parts_on_time_windows,
        parts_changelog,
        parts_count_window,
        parts_pattern,
        parts_stateful_changelog,
        parts_stateful_count_window,
        parts_stateful_pattern,
        rolling_by_bytes,
        rolling_changelog,
    )
}

# Part in which a row arrives, and the watermark that holds when the part begins.
_ARRIVED = f"""
    arrived AS (
      SELECT *, least((event_id - low) // ((high - low) // {PARTS} + 1)
                      + CASE WHEN event_id % {STRAGGLERS} = 0 THEN 1 ELSE 0 END, {PARTS - 1}) AS part,
             time_bucket(INTERVAL '6 hours', ts) AS window_start,
             time_bucket(INTERVAL '6 hours', ts) + INTERVAL '6 hours' AS window_end
      FROM events, (SELECT min(event_id) AS low, max(event_id) AS high FROM events)
    ), passed AS (
      SELECT p.part, max(a.ts) - INTERVAL '10 seconds' AS watermark
      FROM (SELECT DISTINCT part FROM arrived) p JOIN arrived a ON a.part < p.part GROUP BY p.part
    ), judged AS (
      SELECT a.*, coalesce(window_end <= watermark, false) AS is_late
      FROM arrived a LEFT JOIN passed USING (part)
    )"""

ORACLES = {
    "parts_tumble_all": batch.ORACLES["tumble_count_user_1h"],
    "stream_argmax_closed": f"""
        SELECT * FROM ({batch.ORACLES["window_argmax_1h"]})
        WHERE window_end <= (SELECT max(ts) - INTERVAL '3 seconds' FROM events)""",
    "stream_argmax_all": batch.ORACLES["window_argmax_1h"],
    "stream_multi_agg_all": """
        SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
               time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
               max(ts) AS max_ts, count(*) AS counter, round(avg(value), 6) AS mean_value
        FROM events GROUP BY 1, 2""",
    "parts_late_rows": f"""
        WITH {_ARRIVED} SELECT event_id, ts, event_type FROM judged WHERE is_late""",
    "parts_on_time_windows": f"""
        WITH {_ARRIVED}
        SELECT window_start, window_end, event_type, count(*) AS cnt,
               CAST(sum(CAST(trunc(value) AS BIGINT)) AS BIGINT) AS total
        FROM judged WHERE NOT is_late GROUP BY 1, 2, 3""",
    "parts_changelog": batch.ORACLES["changelog_count_user"],
    "parts_count_window": batch.ORACLES["count_window_2"],
    "parts_pattern": batch.ORACLES["pattern_signup_view_purchase_1d"],
    "parts_stateful_changelog": streams.ORACLES["stateful_changelog"],
    "parts_stateful_count_window": batch.ORACLES["count_window_2"],
    "parts_stateful_pattern": batch.ORACLES["pattern_signup_view_purchase_1d"],
    "rolling_by_bytes": """
        SELECT user_id || ' ' || event_type || ' ' || props AS line, true AS fits FROM events""",
    "rolling_changelog": f"""
        SELECT concat_ws(',', is_add, user_id, cnt) AS line, true AS fits
        FROM ({streams.ORACLES["stateful_changelog"]})""",
}
