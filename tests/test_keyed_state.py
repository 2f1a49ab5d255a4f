"""Per-key state without Spark: calls for many keys, and how often the state is asked."""

import pandas as pd
from pyspark.sql import types as T

from millrace.streaming import stateful


class _State:
    """Map, list and value state of a handle, with the calls made."""

    def __init__(self):
        self.map, self.rows, self.value, self.calls = {}, [], None, []

    def getMapState(self, name, key, value):
        return self

    def getListState(self, name, schema):
        return _Kept(self)

    def getValueState(self, name, schema):
        return _Newest(self)

    def registerTimer(self, at):
        self.calls.append("timer")

    def containsKey(self, key):
        return key in self.map

    def getValue(self, key):
        return self.map[key]

    def updateValue(self, key, value):
        self.map[key] = value


class _Kept:
    def __init__(self, state):
        self.state = state

    def get(self):
        self.state.calls.append("rows")
        return iter(self.state.rows)

    def clear(self):
        self.state.calls.append("clear")
        self.state.rows = []

    def appendList(self, rows):
        self.state.calls.append("append")
        self.state.rows += rows


class _Newest:
    def __init__(self, state):
        self.state = state

    def exists(self):
        return self.state.value is not None

    def get(self):
        return self.state.value

    def update(self, value):
        self.state.calls.append("newest")
        self.state.value = value


BIG = (1 << 53) + 1


def _bucket(rows, *values):
    """Rows of key, order and values as a bucket's columns."""
    frame = pd.DataFrame(
        {
            "k0": [0 if row[0] is None else row[0] for row in rows],
            "k0_null": [row[0] is None for row in rows],
            "o0": [row[1] for row in rows],
            "o0_null": False,
        }
    )
    for position, name in enumerate(values, 2):
        frame[name] = [row[position] for row in rows]
    return iter([frame.iloc[:2], frame.iloc[2:]])


def _lines(found):
    return [
        tuple(None if pd.isna(value) else value for value in row)
        for frame in found
        for row in frame.itertuples(index=False, name=None)
    ]


def test_changelog_takes_many_keys_in_one_call():
    state = _State()
    counts = stateful._ChangelogCount(["k"], [T.LongType()], ["i"], "cnt")
    counts.init(state)
    rows = [(BIG, 3, 1), (None, 1, 0), (0, 9, 1), (BIG, 1, 1), (None, 2, 1)]
    found = _lines(counts.handleInputRows((7,), _bucket(rows, "v0"), None))
    assert sorted(found, key=str) == sorted(
        [
            (True, 1, BIG), (False, 1, BIG), (True, 2, BIG),
            (True, 0, None), (False, 0, None), (True, 1, None),
            (True, 1, 0),
        ],
        key=str,
    )
    assert state.map == {(BIG,): (2,), (None,): (1,), (0,): (1,)}
    again = _lines(counts.handleInputRows((7,), _bucket([(0, 10, 1), (0, 11, 0)], "v0"), None))
    assert again == [(False, 1, 0), (True, 2, 0)]
    assert state.map[(0,)] == (2,)


def test_count_windows_take_many_keys_in_one_call():
    state = _State()
    windows = stateful._CountWindows(["k"], [T.LongType()], ["i"], 2)
    windows.init(state)
    rows = [(1, 5, 7, 1), (None, 1, 0, 0), (1, 4, -2, 1), (1, 6, -9, 1), (None, 2, 0, 0), (2, 1, 3, 1)]
    found = _lines(windows.handleInputRows((7,), _bucket(rows, "v0", "v1"), None))
    assert sorted(found, key=lambda row: row[1] is None) == [(0, 5, 2.0, 1), (0, None, None, None)]
    assert state.map == {(1,): (1, 1, -9, 1), (None,): (1, 0, 0, 0), (2,): (0, 1, 3, 1)}
    more = [(1, 7, 0, 0), (2, 2, 4, 1), (2, 3, 5, 1)]
    found = _lines(windows.handleInputRows((7,), _bucket(more, "v0", "v1"), None))
    assert sorted(found) == [(0, 7, 3.0, 2), (1, -9, -9.0, 1)]
    assert state.map[(1,)] == (2, 0, 0, 0) and state.map[(2,)] == (1, 1, 5, 1)


def test_a_new_keys_pattern_state_is_only_written():
    names = ["k", "ts", "id", "_micros", "_is_0", "_is_1"]
    state = _State()
    kept = T.StructType().add("ts", "timestamp_ntz").add("id", "long").add("_micros", "long")
    kept = kept.add("_is_0", "boolean").add("_is_1", "boolean")
    pattern = stateful._Pattern(names, ["k"], ["ts", "id"], ["a", "b"], ["id"], 10_000_000, 0, kept)
    pattern.init(state)

    def batch(*rows):
        filled = [(1, pd.Timestamp(s, unit="s"), i, s * 1_000_000, a, not a) for s, i, a in rows]
        return iter([pd.DataFrame(filled, columns=[f"c{k}" for k in range(len(names))])])

    assert list(pattern.handleInputRows((1,), batch((5, 2, False), (3, 1, True)), None))[0].values.tolist() == [[1, 1, 2]]
    assert state.calls == ["append", "newest", "timer"]
    assert sorted(row[1] for row in state.rows) == [1, 2]
    found = _lines(pattern.handleInputRows((1,), batch((9, 3, False)), None))
    assert found == [(1, 1, 3)]
    found = _lines(pattern.handleInputRows((1,), batch((90, 4, False)), None))
    assert found == [] and [row[1] for row in state.rows] == [4]
