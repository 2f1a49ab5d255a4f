"""User functions over the rows of a window, without buffering the window.

For functions that need the rows themselves, in order.  What an aggregate can say is
cheaper as one: rows are then combined before the shuffle, here all of them are moved and
sorted.  A task reads its windows one after the other; the function gets a window's rows
as an iterator of Arrow batches and holds of them what it needs, no more.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# What runs in tasks travels with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_BATCH = 10_000
START, END = "window_start", "window_end"


class _Cursor:
    """The groups of consecutive equal keys in a stream of batches, one after the other."""

    def __init__(self, batches: Iterator[pa.RecordBatch], keys: Sequence[str]):
        self._batches, self._keys = batches, list(keys)
        self._batch: pa.RecordBatch | None = None
        self._at = 0
        self._ends = np.zeros(0, np.int64)
        self._next_batch()

    def _next_batch(self) -> None:
        self._batch = next((batch for batch in self._batches if len(batch)), None)
        self._at = 0
        if self._batch is not None:
            self._ends = np.append(self._changes(self._batch), len(self._batch))

    def _changes(self, batch: pa.RecordBatch) -> np.ndarray:
        """Places whose row has another key than the row before; null equals null."""
        differs = [self._differs(batch[key][:-1], batch[key][1:]) for key in self._keys]
        return np.flatnonzero(reduce(np.logical_or, differs)) + 1

    @staticmethod
    def _differs(left: pa.Array, right: pa.Array) -> np.ndarray:
        unlike = pc.fill_null(pc.not_equal(left, right), False)
        if pa.types.is_floating(left.type):  # NaN is one key
            both = pc.and_(pc.fill_null(pc.is_nan(left), False), pc.fill_null(pc.is_nan(right), False))
            unlike = pc.and_not(unlike, both)
        gone = pc.xor(left.is_null(), right.is_null())
        return pc.or_(unlike, gone).to_numpy(zero_copy_only=False)

    def groups(self) -> Iterator[tuple[tuple, Iterator[pa.RecordBatch]]]:
        while self._batch is not None:
            key = self._key()
            rows = self._rows(key)
            yield key, rows
            for _ in rows:  # what the function left unread
                pass

    def _key(self) -> tuple:
        return tuple(self._batch[name][self._at].as_py() for name in self._keys)

    def _same(self, key: tuple) -> bool:
        here = self._key()
        return all(a == b or (a != a and b != b) for a, b in zip(here, key))

    def _rows(self, key: tuple) -> Iterator[pa.RecordBatch]:
        while self._batch is not None and self._same(key):
            end = int(self._ends[np.searchsorted(self._ends, self._at, side="right")])
            part = self._batch.slice(self._at, end - self._at)
            self._at = end
            more = end == len(self._batch)
            if more:
                self._next_batch()
            yield part
            if not more:
                return


def window_rows(
    df: DataFrame,
    ts: str,
    duration: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    function: Callable[[tuple, Iterator[pa.RecordBatch]], Iterable[tuple]],
    schema: T.StructType,
) -> DataFrame:
    """``window_start, window_end``, keys and what ``function`` returns for each window and key.

    ``function(key, batches)`` gets the window's bounds and the keys' values, and the rows
    of ``df`` in the order of ``order_by``, null first, in any number of batches; it may stop reading
    at any row and returns any number of tuples of ``schema``.  Without ``keys`` the
    windows are global.  A window's rows are read by one task, from sorted and spilled
    files: time, not memory, limits a window's size.  Rows without time are in no window.
    """
    keys = list(keys)
    window = F.window(F.col(ts), duration)
    group = [START, END, *keys]
    rows = df.select("*", window.start.alias(START), window.end.alias(END))
    names = [*group, *[name for name in dict.fromkeys([*df.columns]) if name not in group]]
    out = T.StructType([*[T.StructField(f.name, f.dataType) for f in rows.select(*group).schema], *schema.fields])
    arrow_schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def packed() -> pa.RecordBatch:
            columns = zip(*waiting) if waiting else ([] for _ in out.names)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), field.type) for c, field in zip(columns, arrow_schema)], schema=arrow_schema
            )

        for key, parts in _Cursor(batches, group).groups():
            for result in function(key, parts):
                waiting.append((*key, *result))
                if len(waiting) == ROWS_PER_BATCH:
                    yield packed()
                    waiting.clear()
        yield packed()

    by_window = rows.select(*names).repartition(START, *keys)
    return by_window.sortWithinPartitions(*group, *order_by).mapInArrow(run, out)
