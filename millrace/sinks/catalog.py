"""Inserting into catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def insert_into(df: DataFrame, table: str, *, overwrite: bool = False) -> None:
    """Fills the table's columns by position."""
    df.write.insertInto(table, overwrite=overwrite)
