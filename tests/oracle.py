"""Comparing Spark rows with the rows DuckDB gives for the SQL of the same name."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    columns = []
    for name in frame.columns:
        column = frame[name]
        if column.dtype.kind == "f":
            column = column.round(6)
        elif column.dtype.kind == "M":
            column = column.astype("datetime64[us]").astype("int64")
        whole = column.astype(object)
        columns.append(whole.where(column.notna(), None).tolist())
    return sorted(zip(*columns), key=repr)


def kinds(frame: pd.DataFrame) -> dict[str, str]:
    return {name: frame[name].dtype.kind for name in sorted(frame.columns)}
