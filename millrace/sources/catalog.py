"""Databases, tables and views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def create_database(
    spark: SparkSession, name: str, location: str | None = None
) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def use(spark: SparkSession, database: str, catalog: str | None = None) -> None:
    if catalog is not None:
        spark.catalog.setCurrentCatalog(catalog)
    spark.catalog.setCurrentDatabase(database)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    fmt: str,
    *,
    location: str | None = None,
    partition_columns: int = 0,
) -> None:
    """An empty table; its last ``partition_columns`` columns partition it."""
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in schema
    )
    statement = f"CREATE TABLE {name} ({columns}) USING {fmt}"
    if partition_columns:
        last = ", ".join(f"`{n}`" for n in trailing(schema.names, partition_columns))
        statement += f" PARTITIONED BY ({last})"
    if location:
        statement += f" LOCATION '{location}'"
    spark.sql(statement)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def trailing(names: Sequence[str], count: int) -> list[str]:
    return list(names[len(names) - count :])


def save_table(
    df: DataFrame,
    name: str,
    *,
    partition_columns: int = 0,
    location: str | None = None,
    fmt: str = "parquet",
    mode: str = "errorifexists",
) -> None:
    """A new table from a frame; its last ``partition_columns`` columns partition it.

    Rows are gathered by partition value before writing, so that a value ends up in
    few files; Spark splits the values that would make a task too large.
    """
    last = trailing(df.columns, partition_columns)
    writer = (df.hint("rebalance", *last) if last else df).write.format(fmt).mode(mode)
    if last:
        writer = writer.partitionBy(*last)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def view(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Registers a frame, or some of its columns, for SQL."""
    shown = df.select(*columns) if columns else df
    shown.createOrReplaceTempView(name)
    return shown
