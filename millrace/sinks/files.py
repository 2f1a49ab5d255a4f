"""Text and CSV output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.streaming.run import start

BUCKET_PATTERN = "yyyy-MM-dd--HH"
ROLL_INTERVAL = "2 seconds"
MICROS_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_text(
    df: DataFrame, path: str, line: Column, *, overwrite: bool = False
) -> None:
    """One line per row; an existing path is an error unless ``overwrite``."""
    mode = "overwrite" if overwrite else "errorifexists"
    df.select(line.cast("string").alias("value")).write.mode(mode).text(path)


def write_csv(
    df: DataFrame,
    path: str,
    *,
    delimiter: str = ",",
    overwrite: bool = False,
    single_file: bool = False,
    null_text: str = "",
) -> None:
    """Delimited files; texts keep blanks, quotes and line breaks.

    ``null_text`` is written for null and must be no value's text for both to be told
    apart.  ``single_file`` is for small results: one task writes it all.
    """
    mode = "overwrite" if overwrite else "errorifexists"
    out = df.coalesce(1) if single_file else df
    # Six digits, so that timestamps survive the round trip.
    writer = out.write.mode(mode).options(
        timestampFormat=MICROS_PATTERN,
        timestampNTZFormat=MICROS_PATTERN,
        nullValue=null_text,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    writer.csv(path, sep=delimiter)


def rolling_text(
    df: DataFrame,
    line: Column,
    path: str,
    checkpoint: str,
    *,
    interval: str | None = ROLL_INTERVAL,
    max_records_per_file: int = 0,
) -> StreamingQuery:
    """Streams lines into folders named by the hour of processing.

    Each micro-batch closes its files, so ``interval`` is the roll-over time; readers
    of the folder see them only after the micro-batch is committed.
    ``max_records_per_file`` rolls within one by size.  File names are Spark's own.
    """
    bucket = F.date_format(F.current_timestamp(), BUCKET_PATTERN)
    writer = (
        df.select(line.cast("string").alias("value"), bucket.alias("bucket"))
        .writeStream.format("text")
        .partitionBy("bucket")
        .option("path", path)
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    return start(writer, df.sparkSession, checkpoint, interval=interval)
