"""Queries by user functions written in Python, over Arrow batches."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.batchaggregates import Fold, aggregate_batches
from millrace.operators.tablefunctions import register_table_functions
from millrace.operators.windowrows import window_rows
from millrace.plans.tables import table

# What runs in tasks travels with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

def props_by_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of the JSON text, by a table function called in SQL."""
    register_table_functions(spark)
    return spark.sql(
        "SELECT id AS event_id, name, number FROM json_members(TABLE(SELECT event_id AS id, props AS text FROM {events}))",
        events=table(spark, sf_dir, "events"),
    )


def _gaps(key: tuple, batches) -> list[tuple]:
    """Rows of a window, and the longest time between two in a row, -1 for a single row."""
    count, longest, last = 0, -1, None
    for batch in batches:
        micros = batch["ts"].cast("int64").to_numpy()
        steps = np.diff(micros) if last is None else np.diff(micros, prepend=last)
        if len(steps):
            longest = max(int(steps.max()), longest)
        count, last = count + len(micros), micros[-1]
    return [(count, longest)]


GAPS = T.StructType([T.StructField("n", T.LongType()), T.StructField("longest_gap", T.LongType())])


def window_gap_user_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function over the rows of each user's day."""
    events = table(spark, sf_dir, "events").select("ts", "user_id")
    return window_rows(events, "ts", "1 day", ["user_id"], ["ts"], _gaps, GAPS)


def window_gap_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over global windows."""
    events = table(spark, sf_dir, "events").select("ts")
    return window_rows(events, "ts", "1 hour", [], ["ts"], _gaps, GAPS)


def _middle(key: tuple, batches) -> list[tuple]:
    """The lower median; of the rows, their values are held only."""
    values = np.sort(np.concatenate([batch["value"].to_numpy(zero_copy_only=False) for batch in batches]))
    return [(float(values[(len(values) - 1) // 2]),)]


def window_median_type_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    median = T.StructType([T.StructField("median_value", T.DoubleType())])
    return window_rows(events, "ts", "6 hours", ["event_type"], [], _middle, median)


def _count_hours(states: dict, codes: np.ndarray, batch) -> None:
    np.add.at(states["hours"], (codes, pc.hour(batch["ts"]).to_numpy()), 1)


def _add_hours(states: dict, codes: np.ndarray, others: dict) -> None:
    np.add.at(states["hours"], codes, others["hours"])


def _around_the_clock(states: dict) -> list[np.ndarray]:
    """Busiest hour (the earliest of equals), its count, and the longest stretch of idle hours, over midnight too."""
    hours = states["hours"]
    idle = np.concatenate([hours, hours], axis=1) == 0
    stretch, longest = np.zeros(len(hours), np.int64), np.zeros(len(hours), np.int64)
    for column in idle.T:
        stretch = np.where(column, stretch + 1, 0)
        longest = np.maximum(longest, stretch)
    return [hours.argmax(axis=1), hours.max(axis=1), np.minimum(longest, 24)]


CLOCK = Fold({"hours": np.zeros(24, np.int64)}, _count_hours, _add_hours, _around_the_clock)
AROUND = T.StructType([T.StructField(name, T.LongType()) for name in ("busiest_hour", "most", "idle_hours")])


def around_the_clock_user_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a day looks like for each user and type of event: an aggregate over batches."""
    # Without a zone the hour is that of the value as it is stored.
    ts = F.col("ts").cast("timestamp_ntz").alias("ts")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", ts)
    return aggregate_batches(events, ["user_id", "event_type"], CLOCK, AROUND)


QUERIES = {
    function.__name__: function
    for function in (
        props_by_table_function,
        window_gap_user_1d,
        window_gap_1h,
        window_median_type_6h,
        around_the_clock_user_type,
    )
}

ORACLES = {
    "window_gap_user_1d": """
        SELECT window_start, window_start + INTERVAL '1 day' AS window_end, user_id, count(*) AS n,
               coalesce(max(gap), -1) AS longest_gap
        FROM (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (
                PARTITION BY user_id, window_start ORDER BY ts) AS gap
              FROM (SELECT *, time_bucket(INTERVAL '1 day', ts) AS window_start FROM events))
        GROUP BY user_id, window_start""",
    "window_gap_1h": """
        SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, count(*) AS n,
               coalesce(max(gap), -1) AS longest_gap
        FROM (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (
                PARTITION BY window_start ORDER BY ts) AS gap
              FROM (SELECT *, time_bucket(INTERVAL '1 hour', ts) AS window_start FROM events))
        GROUP BY window_start""",
    "window_median_type_6h": """
        SELECT window_start, window_start + INTERVAL '6 hours' AS window_end, event_type,
               list_sort(list(value))[(count(*) - 1) // 2 + 1] AS median_value
        FROM (SELECT *, time_bucket(INTERVAL '6 hours', ts) AS window_start FROM events)
        GROUP BY window_start, event_type""",
    "around_the_clock_user_type": """
        WITH hours AS (
          SELECT user_id, event_type, CAST(hour(ts) AS BIGINT) AS h, count(*) AS n FROM events GROUP BY ALL
        ), gaps AS (
          SELECT *, coalesce(lead(h) OVER w, min(h) OVER (PARTITION BY user_id, event_type) + 24) - h - 1 AS gap
          FROM hours WINDOW w AS (PARTITION BY user_id, event_type ORDER BY h)
        )
        SELECT user_id, event_type, CAST(split_part(max(lpad(CAST(n AS VARCHAR), 18, '0') || ':' ||
                 lpad(CAST(23 - h AS VARCHAR), 2, '0')), ':', 2) AS BIGINT) * -1 + 23 AS busiest_hour,
               max(n) AS most, max(gap) AS idle_hours
        FROM gaps GROUP BY user_id, event_type""",
    "props_by_table_function": """
        SELECT event_id, 'k' AS name,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS number
        FROM events""",
}
