"""Per-key state on streams: changelog, count windows, ordered patterns.

A key's order is serial, so its rows of one micro-batch meet in one task.  Bound
the micro-batch at the source (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``)
and that task is bounded too.  Changelog and count windows take the keys of a bucket at a
time, because a call for each key would cost more than its rows; their state is still
read and written key by key.  A pattern also keeps the key's rows within its bound,
and loads them when the key arrives.  For keys too large for that, and for working
off a backlog, use ``streaming.microbatch``, which splits hot keys.

Within a micro-batch rows are taken in the order of ``order_by``; across
micro-batches, in order of arrival.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.pattern import Stage

# Executors get the processors themselves and need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROW_LIMIT = 100_000
KEY_BUCKETS = 1 << 10  # part of the state's layout: a checkpoint keeps to it


def _numbered(df: DataFrame) -> DataFrame:
    """Columns named by position: PySpark's worker mangles some names, ``_x`` for one."""
    return df.toDF(*[f"c{position}" for position in range(len(df.columns))])


def _per_key(
    df: DataFrame, keys: Sequence[str], processor: StatefulProcessor, schema, time: str = "none"
) -> DataFrame:
    numbers = [f"c{df.columns.index(key)}" for key in keys]
    return (
        _numbered(df)
        .groupBy(*numbers)
        .transformWithStateInPandas(processor, schema, "append", time)
    )


def _exact(df: DataFrame, name: str, to: str) -> list[Column]:
    """A column and whether it is null; pandas would turn whole numbers with nulls into floats."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, (T.IntegralType, T.BooleanType)):
        value = F.coalesce(value, F.lit(0).cast(df.schema[name].dataType))
    return [value.alias(to), F.col(name).isNull().alias(f"{to}_null")]


def _per_bucket(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    values: Sequence[Column],
    processor: _Keyed,
    schema: T.StructType,
) -> DataFrame:
    """Rows of many keys at a time, as ``k0, k0_null, ..., o0, o0_null, ..., v0, ...``."""
    # Order columns have their flags too: nulls come last.
    return (
        df.select(
            F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).alias("bucket"),
            *[column for k, name in enumerate(keys) for column in _exact(df, name, f"k{k}")],
            *[column for k, name in enumerate(order_by) for column in _exact(df, name, f"o{k}")],
            *[value.alias(f"v{k}") for k, value in enumerate(values)],
        )
        .groupBy("bucket")
        .transformWithStateInPandas(processor, schema, "append", "none")
    )


class _Keyed(StatefulProcessor):
    """A value of the state for each key of a bucket, read and written once a micro-batch."""

    def __init__(
        self, keys: Sequence[str], types: Sequence[T.DataType], order_by: Sequence[str], state: str
    ):
        self._keys, self._types = list(keys), list(types)
        self._order_by, self._state = list(order_by), state

    def init(self, handle: StatefulProcessorHandle) -> None:
        key = T.StructType([T.StructField(f"k{k}", kind) for k, kind in enumerate(self._types)])
        self._held = handle.getMapState("keys", key, self._state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        frame = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        names = [f"k{k}{end}" for k in range(len(self._keys)) for end in ("_null", "")]
        group = frame.groupby(names, sort=False, dropna=False).ngroup().to_numpy()
        order = [
            frame[f"o{k}{end}"].to_numpy()
            for k in range(len(self._order_by))
            for end in ("_null", "")
        ]
        order = _ascending([group, *order])
        frame, group = frame.iloc[order].reset_index(drop=True), group[order]
        begin = np.flatnonzero(np.diff(group, prepend=-1))
        known = _objects(frame.iloc[begin], len(self._keys))
        held = [self._held.getValue(one) if self._held.containsKey(one) else None for one in known]
        number = np.cumsum(np.diff(group, prepend=-1) != 0) - 1
        found, row, after = self._step(frame, number, begin, held)
        for one, value in zip(known, after):
            self._held.updateValue(one, value)
        for k, name in enumerate(self._keys):
            column = frame[f"k{k}"].iloc[row].reset_index(drop=True)
            null = frame[f"k{k}_null"].to_numpy(dtype=bool)[row]
            found[name] = column.astype(object).where(~null, None) if null.any() else column
        yield found

    def _step(self, frame, number, begin, held) -> tuple[pd.DataFrame, np.ndarray, list[tuple]]:
        """What to report, the row whose key each line has, and the state of each key.

        Rows come by key and in order; ``number`` tells the key, ``begin`` its first row.
        """
        raise NotImplementedError

    def close(self) -> None:
        pass


def _ascending(columns: Sequence[np.ndarray]) -> np.ndarray:
    """The stable order of rows, nulls last, the first column first."""
    if any(column.dtype == object for column in columns):
        frame = pd.DataFrame(dict(enumerate(columns)))
        return frame.sort_values(list(frame.columns), kind="stable").index.to_numpy()
    return np.lexsort(columns[::-1])


def _objects(frame: pd.DataFrame, keys: int) -> list[tuple]:
    """The keys of rows as the state knows them."""
    columns = []
    for k in range(keys):
        values = frame[f"k{k}"].astype(object).to_list()
        columns.append([None if no else v for v, no in zip(values, frame[f"k{k}_null"])])
    return list(zip(*columns))


def _with_keys(frame: pd.DataFrame, keys: Sequence[str], key: tuple) -> pd.DataFrame:
    for name, value in zip(keys, key):
        frame[name] = value
    return frame


def _schema(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [df.schema[name] for name in names]


class _ChangelogCount(_Keyed):
    def __init__(self, keys, types, order_by, out):
        super().__init__(keys, types, order_by, "value long")
        self._out = out

    def _step(self, frame, number, begin, held):
        step = frame["v0"].to_numpy(dtype="int64")
        before = np.array([0 if one is None else one[0] for one in held], dtype="int64")
        total = np.cumsum(step)
        after = (before - (total - step)[begin])[number] + total
        changed = step == 1
        adds = changed.copy()
        retracts = changed.copy()
        new = begin[[one is None for one in held]]
        adds[new], retracts[new] = True, False
        # Retraction and addition of one input row lie next to each other.
        emit = np.column_stack([retracts, adds]).ravel()
        values = np.column_stack([after - step, after]).ravel()[emit]
        found = pd.DataFrame({"is_add": np.tile([False, True], len(step))[emit]})
        found[self._out] = values
        last = np.append(begin[1:], len(step)) - 1
        row = np.repeat(np.arange(len(step)), 2)[emit]
        return found, row, [(count,) for count in after[last].tolist()]


def stream_changelog_count(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    counted: str | None = None,
    *,
    out: str = "cnt",
) -> DataFrame:
    """The streaming form of ``changelog_count``: an append-only stream of changes."""
    step = F.lit(1) if counted is None else F.col(counted).isNotNull().cast("int")
    schema = T.StructType(
        [
            T.StructField("is_add", T.BooleanType()),
            *_schema(df, keys),
            T.StructField(out, T.LongType()),
        ]
    )
    processor = _ChangelogCount(keys, [df.schema[key].dataType for key in keys], order_by, out)
    return _per_bucket(df, keys, order_by, [step.cast("bigint")], processor, schema)


class _CountWindows(_Keyed):
    def __init__(self, keys, types, order_by, size):
        super().__init__(
            keys, types, order_by, "window long, rows long, total long, values long"
        )
        self._size = size

    def _step(self, frame, number, begin, held):
        rows = np.diff(np.append(begin, len(number)))
        window, filled, total, known = np.array(
            [(0, 0, 0, 0) if one is None else tuple(one) for one in held], dtype="int64"
        ).T
        place = filled[number] + np.arange(len(number)) - begin[number]
        offset = place // self._size
        # The first row of each window, or of what a window has of this micro-batch.
        first = np.flatnonzero((np.diff(number, prepend=-1) != 0) | (np.diff(offset, prepend=-1) != 0))
        sums = np.add.reduceat(frame["v0"].to_numpy(dtype="int64"), first)
        counts = np.add.reduceat(frame["v1"].to_numpy(dtype="int64"), first)
        of, offset = number[first], offset[first]
        opening = np.searchsorted(first, begin)
        sums[opening] += total
        counts[opening] += known
        closed = (filled + rows) // self._size
        left = (filled + rows) % self._size
        final = np.searchsorted(of, np.arange(len(begin)), side="right") - 1
        after = np.column_stack(
            [window + closed, left, np.where(left, sums[final], 0), np.where(left, counts[final], 0)]
        )
        done = offset < closed[of]
        of, sums, counts, row = of[done], sums[done], counts[done], first[done]
        # Whole-number division with the fraction cut off, also below zero.
        mean = np.sign(sums) * (np.abs(sums) // np.maximum(counts, 1))
        found = pd.DataFrame({"window_index": window[of] + offset[done]})
        found["total"] = pd.array(sums, dtype="Int64")
        found["mean"] = pd.array(mean, dtype="Float64")
        found.loc[counts == 0, ["total", "mean"]] = pd.NA
        return found, row, [tuple(one) for one in after.tolist()]


def stream_count_windows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    size: int,
    value: str,
) -> DataFrame:
    """Sum and truncated mean of every ``size`` consecutive rows of a key.

    An unfilled window stays in the state, as a count and a sum.
    """
    schema = T.StructType(
        [
            *_schema(df, keys),
            T.StructField("window_index", T.LongType()),
            T.StructField("total", T.LongType()),
            T.StructField("mean", T.DoubleType()),
        ]
    )
    # Null adds nothing to a window but takes one of its places; see ``closed_windows``.
    number = F.coalesce(F.col(value).cast("bigint"), F.lit(0))
    has = F.col(value).isNotNull().cast("bigint")
    processor = _CountWindows(keys, [df.schema[key].dataType for key in keys], order_by, size)
    return _per_bucket(df, keys, order_by, [number, has], processor, schema)


def _extended(
    chains: np.ndarray, low: np.ndarray, candidates: Sequence[np.ndarray]
) -> Iterator[np.ndarray]:
    """Chains with a candidate of each list put in front, the last list first.

    Candidates are sorted; a chain takes those from its ``low`` to before its first row.
    """
    if not candidates:
        yield chains
        return
    rows = candidates[-1]
    begin = np.searchsorted(rows, low)
    counts = np.maximum(np.searchsorted(rows, chains[:, 0]) - begin, 0)
    first = 0
    while first < len(chains):
        fitting = np.searchsorted(np.cumsum(counts[first:]), ROW_LIMIT, side="right")
        until = first + max(1, int(fitting))
        part = counts[first:until]
        repeated = np.repeat(chains[first:until], part, axis=0)
        starts = np.repeat(np.cumsum(part) - part, part)
        places = np.arange(len(repeated)) - starts + np.repeat(begin[first:until], part)
        if len(repeated):
            yield from _extended(
                np.column_stack([rows[places], repeated]),
                np.repeat(low[first:until], part),
                candidates[:-1],
            )
        first = until


def _columns(
    rows: Iterator[pd.DataFrame], names: Sequence[str], wanted: Sequence[str]
) -> dict[str, np.ndarray]:
    """The wanted columns as arrays: a frame's own operations cost more than a key's few rows."""
    frames = list(rows)
    frame = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    place = {name: position for position, name in enumerate(names)}
    return {name: frame[f"c{place[name]}"].to_numpy() for name in wanted}


def _values(column: np.ndarray) -> list:
    """Python values for the state, null for what pandas calls missing."""
    missing = pd.isna(column)
    values = (column.astype("datetime64[us]") if column.dtype.kind == "M" else column).tolist()
    if missing.any():
        values = [None if no else value for value, no in zip(values, missing)]
    return values


class _Pattern(StatefulProcessor):
    """Keeps the rows of all stages, as far back as a late row's matches reach.

    New rows are added to those kept; these are written anew only when half of them are too
    old, so a row is written about twice in all.  A timer at the key's newest row ends an
    idle key: once the watermark is there, no row to come can match any of its rows.
    """

    def __init__(
        self, input_names, keys, order_by, stages, columns, within, lateness, state_schema
    ):
        self._input_names, self._keys = input_names, keys
        self._order_by, self._stages = order_by, stages
        self._columns, self._within, self._lateness = columns, within, lateness
        self._state_schema = state_schema
        self._names = state_schema.names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._kept = handle.getListState("kept", self._state_schema)
        self._newest = handle.getValueState("newest", "micros long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = _columns(rows, self._input_names, self._names)
        # A key has rows of the state only along with its newest time.
        seen = self._newest.get()[0] if self._newest.exists() else None
        held = list(self._kept.get()) if seen is not None else []
        known = new
        if held:
            old = pd.DataFrame(held, columns=self._names)
            old = old[old["_micros"] >= seen - self._within - self._lateness]
            known = {
                name: pd.concat([old[name], pd.Series(new[name])]).to_numpy()
                if len(old)
                else new[name]
                for name in self._names
            }
        fresh = np.arange(len(known["_micros"])) >= len(known["_micros"]) - len(new["_micros"])
        order = _ascending([known[name] for name in self._order_by])
        in_order = {name: values[order] for name, values in known.items()}
        micros = in_order["_micros"].astype("int64", copy=False)
        flags = [
            in_order[f"_is_{position}"].astype(bool, copy=False)
            for position in range(len(self._stages))
        ]
        yield from self._matches(in_order, micros, flags, fresh[order], key)
        newest = int(max(micros[-1], seen if seen is not None else micros[-1]))
        horizon = newest - self._within - self._lateness
        recent = known["_micros"] >= horizon
        still = int(recent[~fresh].sum())
        if held and 2 * still <= len(held):
            self._kept.clear()
            self._keep(known, np.flatnonzero(recent))
        else:
            self._keep(known, np.flatnonzero(recent & fresh))
        if newest != seen:
            self._newest.update((newest,))
        if seen is None:
            self._wake(newest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self._newest.exists():
            newest = self._newest.get()[0]
            if newest // 1000 + 1 > timerValues.getCurrentWatermarkInMs():  # rows came since
                self._wake(newest)
            else:
                self._kept.clear()
                self._newest.clear()
        yield from ()

    def _wake(self, newest: int) -> None:
        """One timer a key, just behind its newest row."""
        self._handle.registerTimer(newest // 1000 + 1)

    def _keep(self, known: dict[str, np.ndarray], rows: np.ndarray) -> None:
        for first in range(0, len(rows), ROW_LIMIT):
            some = rows[first : first + ROW_LIMIT]
            self._kept.appendList(list(zip(*(_values(known[name][some]) for name in self._names))))

    def _matches(self, known, micros, flags, fresh, key) -> Iterator[pd.DataFrame]:
        """All chains with a new row, in pieces of bounded size."""
        last = np.flatnonzero(flags[-1])
        low = np.searchsorted(micros, micros[last] - self._within)
        news = np.concatenate([[0], np.cumsum(fresh)])
        reachable = news[last + 1] > news[low]
        last, low = last[reachable], low[reachable]
        candidates = [np.flatnonzero(flag) for flag in flags[:-1]]
        for chains in _extended(last[:, None], low, candidates):
            chains = chains[fresh[chains].any(axis=1)]
            if not len(chains):
                continue
            frame = _with_keys(pd.DataFrame(index=range(len(chains))), self._keys, key)
            for position, stage in enumerate(self._stages):
                for column in self._columns:
                    frame[f"{stage}_{column}"] = known[column][chains[:, position]]
            yield frame

    def close(self) -> None:
        pass


def stream_pattern_matches(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    stages: Sequence[Stage],
    columns: Sequence[str],
    *,
    within: timedelta,
    lateness: timedelta = timedelta(0),
) -> DataFrame:
    """The streaming form of ``pattern_matches``, columns named ``<stage>_<column>``.

    A match is given once any of its rows arrives and the others are known, in whatever
    order: rows are kept for ``within`` plus ``lateness`` behind their key's greatest event
    time, and go with it when the watermark, as far behind the greatest event time of
    all, has passed it.  A row that comes behind the watermark is dropped.  Rows without key
    or event time match nothing.
    """
    ts = order_by[0]
    names = [stage.name for stage in stages]
    flags = [
        F.coalesce(stage.condition, F.lit(False)).alias(f"_is_{position}")
        for position, stage in enumerate(stages)
    ]
    some_stage = stages[0].condition
    for stage in stages[1:]:
        some_stage = some_stage | stage.condition
    matchable = F.col(ts).isNotNull()
    for name in keys:
        matchable = matchable & F.col(name).isNotNull()
    prepared = df.where(some_stage & matchable).select(
        *dict.fromkeys([*keys, *order_by, *columns]),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("_micros"),
        *flags,
        F.col(ts).cast("timestamp").alias("_event"),
    )
    delay = (within + lateness) // timedelta(microseconds=1)
    prepared = prepared.withWatermark("_event", f"{delay} microseconds")
    state_schema = T.StructType(
        [
            *_schema(prepared, list(dict.fromkeys([*order_by, *columns]))),
            *_schema(prepared, ["_micros"]),
            *[
                T.StructField(f"_is_{position}", T.BooleanType())
                for position in range(len(stages))
            ],
        ]
    )
    schema = T.StructType(
        [
            *_schema(df, keys),
            *[
                T.StructField(f"{stage}_{name}", df.schema[name].dataType)
                for stage in names
                for name in columns
            ],
        ]
    )
    processor = _Pattern(
        prepared.columns,
        list(keys),
        list(order_by),
        names,
        list(columns),
        within // timedelta(microseconds=1),
        lateness // timedelta(microseconds=1),
        state_schema,
    )
    return _per_key(prepared, keys, processor, schema, "eventTime")
