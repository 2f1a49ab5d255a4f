"""Column expressions on timestamps."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SECONDS_PATTERN = "yyyy-MM-dd HH:mm:ss"
TIME_OF_DAY = r"^\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,9})?$"
LOCAL_OFFSET_HOURS = 8


def at_date(base_date: str, time_of_day: Column) -> Column:
    """A timestamp from a fixed date and ``HH:mm:ss[.f]`` text; null when it does not parse."""
    return F.when(
        time_of_day.rlike(TIME_OF_DAY),
        F.try_to_timestamp(F.concat(F.lit(base_date), F.lit(" "), time_of_day)),
    )


def parse_timestamp(text: Column) -> Column:
    """A timestamp from ``yyyy-MM-dd HH:mm:ss[.ffffff]`` text; null when it does not parse."""
    return F.try_to_timestamp(text)


def format_seconds(ts: Column) -> Column:
    return F.date_format(ts, SECONDS_PATTERN)


def to_millisecond(ts: Column) -> Column:
    """Three fractional digits: the rest is cut off, not rounded."""
    return F.date_trunc("millisecond", ts)


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def from_epoch_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def shifted(ts: Column, hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """The timestamp moved by a fixed number of hours."""
    return ts + F.make_dt_interval(hours=F.lit(hours))


def register_utc2local(spark: SparkSession, hours: int = LOCAL_OFFSET_HOURS) -> None:
    """Make ``utc2local(ts)`` callable from SQL; the body is inlined into the plan."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION utc2local(ts TIMESTAMP) "
        f"RETURNS TIMESTAMP RETURN ts + INTERVAL {int(hours)} HOURS"
    )


def plain_timestamp_text(ts: Column) -> Column:
    """Date, time and at least one fractional digit, without trailing zeros."""
    full = F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, r"(\.\d+?)0*$", "$1")
