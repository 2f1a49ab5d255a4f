"""Projections, filters, grouped aggregates and bag union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def integer_quotient(dividend: Column, divisor: Column) -> Column:
    """Whole-number division, the fraction cut off."""
    return F.call_function("div", dividend, divisor)


def project(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """Exactly the named columns, in the order given: selects, renames, constants."""
    return df.select(
        *[
            (F.col(source) if isinstance(source, str) else source).alias(name)
            for name, source in columns.items()
        ]
    )


def grouped_sum(
    df: DataFrame, keys: Sequence[str], value: Column | str, out: str
) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def grouped_count(
    df: DataFrame, keys: Sequence[str], out: str, counted: Column | str | None = None
) -> DataFrame:
    """Rows per key, or non-null values of ``counted`` per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1) if counted is None else counted).alias(out)
    )


def grouped_sum_having(
    df: DataFrame,
    keys: Sequence[str],
    value: Column | str,
    out: str,
    having: Column,
) -> DataFrame:
    """Grouped sum, then a filter that sees the aggregated column."""
    return grouped_sum(df, keys, value, out).where(having)


def filtered_sum(
    df: DataFrame,
    predicate: Column,
    keys: Sequence[str],
    value: Column | str,
    out: str,
) -> DataFrame:
    return grouped_sum(df.where(predicate), keys, value, out)


def derived_key_sum(
    df: DataFrame,
    source: str,
    divisor: int,
    value: str,
    *,
    above: int,
    key: str = "id",
    out: str = "total",
    narrow_to: str | None = None,
) -> DataFrame:
    """Sum of ``value`` by ``source div divisor``, for derived keys above a bound.

    The sum stays as wide as Spark makes it; ``narrow_to`` casts it on request and
    gives null where the value does not fit.
    """
    if above >= 0 and divisor > 0:
        # The same rows in terms of the stored column, which a file scan can skip by.
        df = df.where(F.col(source) >= (above + 1) * divisor)
    derived = df.select(
        integer_quotient(F.col(source), F.lit(divisor)).alias(key), F.col(value)
    ).where(F.col(key) > above)
    total = F.sum(value)
    return derived.groupBy(key).agg(
        (total.try_cast(narrow_to) if narrow_to else total).alias(out)
    )


def truncated_mean(value: Column | str) -> Column:
    """Mean of whole numbers with the fraction cut off, as a double."""
    column = F.col(value) if isinstance(value, str) else value
    total = F.sum(column.cast("bigint"))
    count = F.count(column)
    return F.when(count > 0, integer_quotient(total, count).cast("double"))


def union_filtered(
    left: DataFrame, left_predicate: Column, right: DataFrame, right_predicate: Column
) -> DataFrame:
    """Bag union by position of two filtered inputs; duplicates stay."""
    return left.where(left_predicate).unionAll(right.where(right_predicate))


def incremental_aggregate(
    df: DataFrame,
    keys: Sequence[str | Column],
    accumulators: Mapping[str, Column],
    result: Mapping[str, Column],
) -> DataFrame:
    """A user-defined aggregate built from mergeable accumulators.

    ``accumulators`` are built-in aggregates, so Spark combines them before the
    shuffle; ``result`` is evaluated once per group on the merged accumulators.
    """
    merged = df.groupBy(*keys).agg(
        *[column.alias(name) for name, column in accumulators.items()]
    )
    kept = [column for column in merged.columns if column not in accumulators]
    return merged.select(
        *kept, *[column.alias(name) for name, column in result.items()]
    )
