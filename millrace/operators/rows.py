"""Row-at-a-time user functions and aggregates, applied to Arrow batches.

For logic the built-in column functions cannot express; prefer those, they stay
inside generated code.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Hashable, Iterable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ROWS_PER_BATCH = 10_000
OPEN_ACCUMULATORS = 50_000


def flat_map_rows(
    df: DataFrame,
    function: Callable[[dict[str, Any]], Iterable[tuple]],
    schema: T.StructType,
) -> DataFrame:
    """Zero or more output rows per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema.names
        arrow_schema = to_arrow_schema(schema)
        for batch in batches:
            yield pa.RecordBatch.from_pylist(
                [
                    dict(zip(names, produced))
                    for record in batch.to_pylist()
                    for produced in function(record)
                ],
                schema=arrow_schema,
            )

    return df.mapInArrow(run, schema)


def map_rows(
    df: DataFrame, function: Callable[[dict[str, Any]], tuple], schema: T.StructType
) -> DataFrame:
    """Exactly one output row per input row."""
    return flat_map_rows(df, lambda record: (function(record),), schema)


def _identity(value: Any) -> Hashable:
    """Equal for values that are one group: NaN is NaN, -0.0 is 0.0, nested values count."""
    if isinstance(value, float):
        return "NaN" if value != value else value + 0.0
    if isinstance(value, dict):
        return tuple((name, _identity(part)) for name, part in value.items())
    if isinstance(value, (list, tuple)):
        return tuple(_identity(part) for part in value)
    return value


def _one_number(df: DataFrame, name: str) -> Column:
    """A key column in which NaN and zero have one form each, as grouping needs."""
    column = F.col(name)
    if not isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return column
    nan = F.lit(float("nan")).cast(df.schema[name].dataType)
    zero = F.lit(0.0).cast(df.schema[name].dataType)
    plain = F.when(F.isnan(column), nan).when(column == 0, zero).otherwise(column)
    return plain.alias(name)


def aggregate_rows(
    df: DataFrame,
    keys: Sequence[str],
    create: Callable[[], Any],
    add: Callable[[Any, dict[str, Any]], Any],
    merge: Callable[[Any, Any], Any],
    result: Callable[[tuple, Any], tuple],
    schema: T.StructType,
    *,
    open_accumulators: int = OPEN_ACCUMULATORS,
) -> DataFrame:
    """A user-defined aggregate with accumulators that can be merged.

    Each task first folds its own rows with ``add``; only accumulators cross the
    shuffle, where those of a key arrive one after the other and are merged on the
    way.  A task holds at most ``open_accumulators`` of them, and no group of rows.
    ``result`` turns a key and its accumulator into an output row.

    To aggregate per window, make the window's bounds key columns.  Keys are one group
    as in ``groupBy``: NaN equals NaN, and arrays and structs are compared by value.
    """
    keys = list(keys)
    df = df.withColumns({name: _one_number(df, name) for name in keys})
    key_schema = df.select(*keys).schema
    partial_schema = T.StructType(
        [*key_schema.fields, T.StructField("_accumulator", T.BinaryType())]
    )

    def batches_of(
        records: Iterator[tuple], fields: T.StructType
    ) -> Iterator[pa.RecordBatch]:
        names, arrow_schema = fields.names, to_arrow_schema(fields)
        waiting = []
        for record in records:
            waiting.append(dict(zip(names, record)))
            if len(waiting) == ROWS_PER_BATCH:
                yield pa.RecordBatch.from_pylist(waiting, schema=arrow_schema)
                waiting = []
        yield pa.RecordBatch.from_pylist(waiting, schema=arrow_schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def accumulators() -> Iterator[tuple]:
            found: dict[Hashable, tuple[tuple, Any]] = {}
            for batch in batches:
                for record in batch.to_pylist():
                    key = tuple(record[name] for name in keys)
                    group = _identity(key)
                    so_far = found[group][1] if group in found else create()
                    found[group] = key, add(so_far, record)
                    if len(found) == open_accumulators:
                        yield from packed(found)
                        found = {}
            yield from packed(found)

        def packed(found: dict) -> Iterator[tuple]:
            return ((*key, pickle.dumps(value)) for key, value in found.values())

        return batches_of(accumulators(), partial_schema)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            current, merged = None, None
            for batch in batches:
                for record in batch.to_pylist():
                    key = tuple(record[name] for name in keys)
                    value = pickle.loads(record["_accumulator"])
                    if current is not None and _identity(key) == _identity(current):
                        merged = merge(merged, value)
                        continue
                    if current is not None:
                        yield result(current, merged)
                    current, merged = key, value
            if current is not None:
                yield result(current, merged)

        return batches_of(results(), schema)

    partial = df.mapInArrow(fold, partial_schema)
    by_key = partial.repartition(*keys).sortWithinPartitions(*keys)
    return by_key.mapInArrow(combine, schema)
