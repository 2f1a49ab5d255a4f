"""Tables and queries of an external database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Names and types of ``schema``, column by column in order."""
    renamed = df.toDF(*schema.names)
    return renamed.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema]
    )


def read_query(
    spark: SparkSession,
    options: Mapping[str, str],
    query: str,
    schema: T.StructType,
) -> DataFrame:
    """The result of a query the database runs; declared types win over the driver's.

    ``options`` holds at least ``url``.  Limits and filters inside ``query`` are the
    database's work.
    """
    loaded = spark.read.format("jdbc").options(**options).option("query", query).load()
    return as_declared(loaded, schema)


def read_table(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    schema: T.StructType,
    *,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
) -> DataFrame:
    """A table read in parallel ranges of ``column``.

    The bounds say where to split; rows outside them arrive too.
    """
    loaded = (
        spark.read.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("partitionColumn", column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )
    return as_declared(loaded, schema)
