"""Writing to an external database."""

from __future__ import annotations

import zlib

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.streaming.run import start


def append(
    df: DataFrame,
    options: Mapping[str, str],
    table: str,
    *,
    column_types: str | None = None,
    by_position: bool = False,
) -> None:
    """Appends rows, creating the table when it is missing.

    ``by_position`` fills the existing table's columns in order, whatever their
    names.  ``column_types`` is a column list in the database's own types.
    """
    if by_position:
        target = (
            df.sparkSession.read.format("jdbc")
            .options(**options)
            .option("dbtable", table)
            .load()
        )
        df = df.toDF(*target.columns)
    writer = (
        df.write.format("jdbc").options(**options).option("dbtable", table)
    ).mode("append")
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.save()


def merge_statement(
    table: str, staging: str, columns: Sequence[str], keys: Sequence[str]
) -> str:
    """Standard SQL that moves the staged rows into the table, the newest value winning."""

    def quoted(name: str) -> str:
        return f'"{name}"'

    matching = " AND ".join(f"t.{quoted(k)} = s.{quoted(k)}" for k in keys)
    others = [name for name in columns if name not in keys]
    update = ", ".join(f"{quoted(n)} = s.{quoted(n)}" for n in others)
    names = ", ".join(quoted(n) for n in columns)
    staged = ", ".join(f"s.{quoted(n)}" for n in columns)
    when_matched = f" WHEN MATCHED THEN UPDATE SET {update}" if others else ""
    return (
        f"MERGE INTO {table} t USING {staging} s ON {matching}{when_matched}"
        f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({staged})"
    )


def upsert(
    df: DataFrame,
    options: Mapping[str, str],
    table: str,
    keys: Sequence[str],
    *,
    staging: str | None = None,
    column_types: str | None = None,
    statement: str | None = None,
) -> None:
    """Inserts or replaces rows by key; ``df`` holds each key once.

    Executors write the rows to a staging table, then the database merges them in a
    single statement.  Repeating it with the same rows changes nothing, so a retried
    task or micro-batch is safe.  ``statement`` replaces the standard ``MERGE`` for
    databases that spell it differently.
    """
    staging = staging or f"{table}_staging"
    writer = (
        df.write.format("jdbc").options(**options).option("dbtable", staging)
    ).mode("overwrite")
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.save()
    merge = statement or merge_statement(table, staging, df.columns, keys)
    # The reader runs the statement when it opens its one connection.
    df.sparkSession.read.format("jdbc").options(**options).option(
        "query", f"SELECT COUNT(*) AS staged FROM {staging}"
    ).option("sessionInitStatement", merge).load().collect()


def stream_upsert(
    result: DataFrame,
    options: Mapping[str, str],
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    *,
    interval: str | None = None,
    staging: str | None = None,
    column_types: str | None = None,
) -> StreamingQuery:
    """Keeps the latest value per key of an updating result in a database table.

    The staging table is the stream's own, named after its checkpoint by default.
    """
    staging = staging or f"{table}_staging_{zlib.crc32(checkpoint.encode()):08x}"

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, options, table, keys, staging=staging, column_types=column_types)

    writer = result.writeStream.outputMode("update").foreachBatch(write)
    return start(writer, result.sparkSession, checkpoint, interval=interval)


def stream_append(
    result: DataFrame,
    options: Mapping[str, str],
    table: str,
    checkpoint: str,
    *,
    interval: str | None = None,
) -> StreamingQuery:
    """Appends each micro-batch; a repeated micro-batch appends its rows again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append(batch, options, table)

    writer = result.writeStream.outputMode("append").foreachBatch(write)
    return start(writer, result.sparkSession, checkpoint, interval=interval)
