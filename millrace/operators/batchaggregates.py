"""User-defined aggregates that fold whole Arrow batches with numpy.

An accumulator is a row of fixed-width columns, so those of many groups are a few arrays
and a batch is folded into them by codes, without a Python object per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.operators.rows import _one_number

HELD_BYTES = 64 << 20
ROWS_PER_BATCH = 10_000
NESTED = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
NUMBERS = {
    np.dtype(np.int32): T.IntegerType(),
    np.dtype(np.int64): T.LongType(),
    np.dtype(np.float32): T.FloatType(),
    np.dtype(np.float64): T.DoubleType(),
}

States = dict[str, np.ndarray]


@dataclass(frozen=True)
class Fold:
    """How accumulators begin, take rows, meet and end.

    ``start`` holds the columns of one fresh accumulator: numbers, or vectors of a fixed
    width.  ``add(states, codes, batch)`` puts the rows of ``batch`` into the accumulators
    that ``codes`` names, ``merge(states, codes, others)`` does so with other accumulators;
    both change ``states`` in place and must not depend on the order.  ``finish(states)``
    gives the result columns, an entry per accumulator.
    """

    start: Mapping[str, np.ndarray]
    add: Callable[[States, np.ndarray, pa.RecordBatch], None]
    merge: Callable[[States, np.ndarray, States], None]
    finish: Callable[[States], Sequence[np.ndarray | pa.Array]]

    def fresh(self, count: int) -> States:
        return {name: np.repeat(np.asarray(one)[None], count, axis=0) for name, one in self.start.items()}


def group_codes(keys: Sequence[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's group, in order of appearance, and the first row of each."""
    codes = np.zeros(len(keys[0]) if keys else 0, np.int64)
    for key in keys:
        coded = key.dictionary_encode(null_encoding="encode")
        codes = codes * max(len(coded.dictionary), 1) + coded.indices.to_numpy()
        codes = np.unique(codes, return_inverse=True)[1]
    _, first, codes = np.unique(codes, return_index=True, return_inverse=True)
    order = np.argsort(first)
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return place[codes], first[order]


def _to_arrow(values: np.ndarray) -> pa.Array:
    if values.ndim == 1:
        return pa.array(values)
    flat = pa.array(np.ascontiguousarray(values).reshape(-1))
    return pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], flat)


def _to_numpy(column: pa.Array, one: np.ndarray) -> np.ndarray:
    if one.ndim == 0:
        return column.to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(one))


def aggregate_batches(
    df: DataFrame,
    keys: Sequence[str],
    fold: Fold,
    result: T.StructType,
    *,
    held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """``keys`` and the columns of ``result``, a row per group of ``df``.

    Each task folds its batches and merges what it has whenever that exceeds
    ``held_bytes``; if more than half is left, it goes to the shuffle, which sorts it.
    Behind the shuffle a key's accumulators are neighbours and are merged as they come, so
    a task never holds a group's rows, nor more than a batch of accumulators.  Keys are one
    group as in ``groupBy`` (null and NaN are keys) and may not be nested; none at all
    is an error, as is a column of ``result`` or of the accumulator that has a key's name.
    """
    keys = list(keys)
    start = {name: np.asarray(one) for name, one in fold.start.items()}
    if not keys:
        raise ValueError("at least one key is needed")
    for name in keys:
        if isinstance(df.schema[name].dataType, NESTED):
            raise TypeError(f"a nested key: {name}")
    if {name.lower() for name in keys} & {name.lower() for name in [*result.names, *start]}:
        raise ValueError("a key has the name of a result or an accumulator's column")
    df = df.withColumns({name: _one_number(df, name) for name in keys})
    key_fields = df.select(*keys).schema.fields
    state_fields = [
        T.StructField(name, T.ArrayType(NUMBERS[one.dtype], False) if one.ndim else NUMBERS[one.dtype])
        for name, one in start.items()
    ]
    partial_schema = T.StructType([*key_fields, *state_fields])
    partial_arrow = to_arrow_schema(partial_schema)
    result_schema = T.StructType([*key_fields, *result.fields])

    def packed(batch: pa.RecordBatch | pa.Table, first: np.ndarray, states: States) -> pa.Table:
        columns = [batch[name].take(pa.array(first)) for name in keys]
        columns += [_to_arrow(states[name]) for name in start]
        return pa.table(columns, names=partial_schema.names).cast(partial_arrow)

    def merged(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        """One row per key, in order of appearance, and the codes of the rows."""
        table = table.combine_chunks()
        codes, first = group_codes([table[name].combine_chunks() for name in keys])
        states = fold.fresh(len(first))
        others = {name: _to_numpy(table[name].combine_chunks(), one) for name, one in start.items()}
        fold.merge(states, codes, others)
        return packed(table, first, states), codes

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not len(batch):
                continue
            codes, first = group_codes([batch[name] for name in keys])
            states = fold.fresh(len(first))
            fold.add(states, codes, batch)
            held.append(packed(batch, first, states))
            if sum(part.nbytes for part in held) > held_bytes:
                held = [merged(pa.concat_tables(held))[0]]
                if held[0].nbytes > held_bytes // 2:
                    yield from held.pop().to_batches(max_chunksize=ROWS_PER_BATCH)
        if held:
            yield from merged(pa.concat_tables(held))[0].to_batches(max_chunksize=ROWS_PER_BATCH)

    def finished(table: pa.Table) -> Iterator[pa.RecordBatch]:
        states = {name: _to_numpy(table[name].combine_chunks(), one) for name, one in start.items()}
        columns = [table[name].combine_chunks() for name in keys]
        columns += [column if isinstance(column, pa.Array) else pa.array(column) for column in fold.finish(states)]
        done = pa.table(columns, names=result_schema.names).cast(to_arrow_schema(result_schema))
        yield from done.to_batches(max_chunksize=ROWS_PER_BATCH)

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.Table | None = None
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch]).cast(partial_arrow)
            table, _ = merged(table if last is None else pa.concat_tables([last, table]))
            # The key of the last row may go on in the next batch; sorted, it is the last group.
            last = table.slice(len(table) - 1)
            if len(table) > 1:
                yield from finished(table.slice(0, len(table) - 1))
        if last is not None:
            yield from finished(last)

    partial = df.mapInArrow(folded, partial_schema)
    by_key = partial.repartition(*keys).sortWithinPartitions(*keys)
    return by_key.mapInArrow(combined, result_schema)
