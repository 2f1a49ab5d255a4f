"""Text lines to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import SPACE, is_not_blank, space_tokens, word_pieces
from millrace.functions.times import at_date


def _with_click_fields(lines: DataFrame, base_date: str, column: str) -> DataFrame:
    fields = F.split(column, SPACE)
    return lines.where(is_not_blank(F.col(column))).select(
        F.get(fields, F.lit(0)).alias("user"),
        at_date(base_date, F.get(fields, F.lit(1))).alias("timestamp"),
        F.get(fields, F.lit(2)).alias("url"),
        F.col(column).alias("line"),
    )


def parse_click_lines(
    lines: DataFrame, base_date: str, column: str = "value"
) -> DataFrame:
    """``user HH:mm:ss url`` lines as click rows; blank and malformed lines give none."""
    return (
        _with_click_fields(lines, base_date, column)
        .where(F.col("timestamp").isNotNull() & F.col("url").isNotNull())
        .drop("line")
    )


def rejected_click_lines(
    lines: DataFrame, base_date: str, column: str = "value"
) -> DataFrame:
    """The non-blank lines that :func:`parse_click_lines` leaves out, as they came."""
    return (
        _with_click_fields(lines, base_date, column)
        .where(F.col("timestamp").isNull() | F.col("url").isNull())
        .select("line")
    )


def with_event_time(
    df: DataFrame, base_date: str, time_column: str = "time", out: str = "timestamp"
) -> DataFrame:
    """Adds the timestamp made of a fixed date and the row's time of day."""
    return df.withColumn(out, at_date(base_date, F.col(time_column)))


def explode_space_tokens(df: DataFrame, column: str, out: str = "word") -> DataFrame:
    """One row per space-separated token; inner empty tokens are rows too."""
    return df.select(F.explode(space_tokens(F.col(column))).alias(out))


def explode_words(df: DataFrame, column: str, out: str = "word") -> DataFrame:
    """One row per lower-cased word."""
    # Filtering rows stays in generated code; filtering inside the array would not.
    pieces = df.select(F.explode(word_pieces(F.col(column))).alias(out))
    return pieces.where(F.length(out) > 0)
