"""Text and CSV files, as tables and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import is_not_blank


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in the column ``value``."""
    return spark.read.text(path)


def stream_text(
    spark: SparkSession, folder: str, *, max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    delimiter: str = ",",
    header: bool = False,
    null_text: str = "",
    multi_line: bool = False,
) -> DataFrame:
    """Rows of delimited files, blanks kept; a malformed row has nulls.

    ``null_text`` stands for null; with the default, empty texts are null, too.
    ``multi_line`` reads quoted line breaks, and each file in one task;
    ``splitcsv.read_split_csv`` reads large files of that kind.
    """
    return spark.read.schema(schema).csv(
        path, **csv_options(delimiter, null_text), header=header, multiLine=multi_line
    )


def csv_options(delimiter: str, null_text: str) -> dict:
    """How ``write_csv`` writes and all readers here read."""
    return {
        "sep": delimiter,
        "nullValue": null_text,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }


def rejected_csv(
    spark: SparkSession, path: str, schema: T.StructType, *, delimiter: str = ","
) -> DataFrame:
    """The lines that do not fit ``schema``, as they came, in the column ``line``.

    For files of one record a line; blank lines are no records.
    """
    watched = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}"
        for field in [*schema.fields, T.StructField("_line", T.StringType())]
    )
    options = {name: str(value) for name, value in csv_options(delimiter, "").items()}
    record = F.from_csv("value", watched, {**options, "columnNameOfCorruptRecord": "_line"})
    return (
        read_text(spark, path)
        .where(is_not_blank(F.col("value")) & record["_line"].isNotNull())
        .select(F.col("value").alias("line"))
    )


def stream_csv(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    *,
    delimiter: str = ",",
    header: bool = False,
    null_text: str = "",
    multi_line: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """The streaming form of :func:`read_csv`, with the same treatment of values."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(
        folder, **csv_options(delimiter, null_text), header=header, multiLine=multi_line
    )
