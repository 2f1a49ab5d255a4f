"""Changelogs: the history of a grouped result as added and retracted rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ordered import (
    DEFAULT_MAX_ROWS,
    Running,
    nothing_carried,
    plan_blocks,
    running,
    with_carried,
)

ROWS = "_rows"
STEP = "_step"


def carried_schema(df: DataFrame, keys: Sequence[str]) -> T.StructType:
    """Per key: whether it was seen, as 1, and its count so far."""
    return df.select(*keys).schema.add(ROWS, T.LongType()).add(STEP, T.LongType())


def changelog_count_step(
    df: DataFrame,
    carried: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    counted: str | None = None,
    *,
    out: str = "cnt",
    max_rows: int = DEFAULT_MAX_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The changes that ``df`` makes to the carried counts, and the counts after it."""
    step = F.lit(1) if counted is None else F.col(counted).isNotNull().cast("int")
    new = df.select(
        *keys,
        *order_by,
        F.lit(1).cast("bigint").alias(ROWS),
        step.cast("bigint").alias(STEP),
    )
    rows = with_carried(new, carried)
    blocks = plan_blocks(rows, keys, order_by, max_rows)
    counts = running(
        blocks.mark(rows),
        blocks,
        {
            "_seen": Running("sum", F.col(ROWS)),
            "_count": Running("sum", F.col(STEP)),
        },
    ).where(~F.col("_carried"))

    def change(is_add: bool, value: str) -> Column:
        return F.struct(F.lit(is_add).alias("is_add"), F.expr(value).alias(out))

    changes = (
        F.when(F.col("_seen") == 1, F.array(change(True, "_count")))
        .when(
            F.col(STEP) == 1,
            F.array(change(False, "_count - 1"), change(True, "_count")),
        )
        .otherwise(F.array().cast(f"array<struct<is_add:boolean,{out}:bigint>>"))
    )
    changed = counts.select(*keys, *order_by, F.explode(changes).alias("_change"))
    after = rows.groupBy(*keys).agg(
        F.lit(1).cast("bigint").alias(ROWS), F.sum(STEP).alias(STEP)
    )
    return changed.select(
        "_change.is_add", *keys, f"_change.{out}", *order_by
    ), after


def changelog_count(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    counted: str | None = None,
    *,
    out: str = "cnt",
    max_rows: int = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """Every change of ``count`` per key, in input order.

    The first row of a key adds its count; each later row that changes the count
    retracts the old value and adds the new one.  A null ``counted`` changes
    nothing, but as first row of its key it adds a count of 0.  The columns of
    ``order_by``, unique within a key, tell which input row caused the change.
    """
    nothing = nothing_carried(df, carried_schema(df, keys))
    changes, _ = changelog_count_step(
        df, nothing, keys, order_by, counted, out=out, max_rows=max_rows
    )
    return changes
