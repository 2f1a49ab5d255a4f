"""Fixed-size count windows per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ordered import (
    DEFAULT_MAX_ROWS,
    Running,
    plan_blocks,
    running,
    with_carried,
)
from millrace.operators.relational import integer_quotient

ROWS = "_rows"
TOTAL = "_total"
FILLED = "_filled"
DONE = "_done"


def count_windows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    size: int,
    aggregates: Mapping[str, Column],
    *,
    index: str = "window_index",
    max_rows: int = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """Aggregates of every ``size`` consecutive rows of a key.

    The last rows of a key that do not fill a window give nothing.  ``order_by``
    must be unique within a key.
    """
    blocks = plan_blocks(df, keys, order_by, max_rows)
    numbered = running(
        blocks.mark(df), blocks, {"_row": Running("sum", F.lit(1).cast("bigint"))}
    )
    window = integer_quotient(F.col("_row") - 1, F.lit(size)).alias(index)
    return (
        numbered.groupBy(*keys, window)
        .agg(
            *[column.alias(name) for name, column in aggregates.items()],
            F.count(F.lit(1)).alias("_size"),
        )
        .where(F.col("_size") == size)
        .drop("_size")
    )


def carried_schema(df: DataFrame, keys: Sequence[str]) -> T.StructType:
    """Per key: rows, total and values of the open window, and how many are closed."""
    schema = df.select(*keys).schema
    for name in (ROWS, TOTAL, FILLED, DONE):
        schema = schema.add(name, T.LongType())
    return schema


def count_windows_step(
    df: DataFrame,
    carried: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    size: int,
    value: str,
    *,
    max_rows: int = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """All windows that ``df`` and the carried open windows touch, closed or not.

    :func:`closed_windows` and :func:`open_windows` tell them apart.
    """
    new = df.select(
        *keys,
        *order_by,
        F.lit(1).cast("bigint").alias(ROWS),
        F.coalesce(F.col(value).cast("bigint"), F.lit(0)).alias(TOTAL),
        F.col(value).isNotNull().cast("bigint").alias(FILLED),
        F.lit(0).cast("bigint").alias(DONE),
    )
    rows = with_carried(new, carried)
    blocks = plan_blocks(rows, keys, order_by, max_rows)
    placed = running(
        blocks.mark(rows),
        blocks,
        {
            "_position": Running("sum", F.col(ROWS)),
            "_base": Running("sum", F.col(DONE)),
        },
    )
    # A carried row without open rows has position 0 and touches window 0 as well.
    window = integer_quotient(F.greatest(F.col("_position") - 1, F.lit(0)), F.lit(size))
    return placed.groupBy(*keys, (F.col("_base") + window).alias("window_index")).agg(
        F.sum(ROWS).alias(ROWS), F.sum(TOTAL).alias("total"), F.sum(FILLED).alias(FILLED)
    )


def closed_windows(
    windows: DataFrame, keys: Sequence[str], size: int
) -> DataFrame:
    """Sum and truncated mean of the windows that are full.

    A null row counts as a row but adds no value: the mean is that of the values, and
    without any both are null.
    """
    some = F.col(FILLED) > 0
    mean = integer_quotient(F.col("total"), F.col(FILLED)).cast("double")
    return windows.where(F.col(ROWS) == size).select(
        *keys,
        "window_index",
        F.when(some, F.col("total")).alias("total"),
        F.when(some, mean).alias("mean"),
    )


def open_windows(windows: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """What the next step has to carry."""
    full = F.col(ROWS) == size
    return windows.groupBy(*keys).agg(
        F.sum(F.when(full, 0).otherwise(F.col(ROWS))).alias(ROWS),
        F.sum(F.when(full, 0).otherwise(F.col("total"))).alias(TOTAL),
        F.sum(F.when(full, 0).otherwise(F.col(FILLED))).alias(FILLED),
        F.max(F.col("window_index") + full.cast("bigint")).alias(DONE),
    )
