"""What streams carry between micro-batches, and what they leave behind."""

from __future__ import annotations

import os
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from millrace.operators import windows
from millrace.operators.changelog import changelog_count
from millrace.operators.pattern import Stage, pattern_matches
from millrace.plans import arrivals
from millrace.streaming import flush, late, microbatch
from millrace.streaming.run import all_batches, run_append
from millrace.streaming.stateful import stream_pattern_matches
from millrace.streaming.watermarks import with_watermark
from tests.fixtures import tuples

SF_DIR = "/root/testdata/sf0.001"
EVENT = "key string, ts timestamp, seq bigint"


def moment(hours):
    return datetime(2024, 1, 1) + timedelta(hours=hours)


class Source:
    """A folder to which rows are added, one file at a time."""

    def __init__(self, spark, folder, schema=EVENT):
        self.spark, self.folder, self.schema = spark, str(folder), schema

    def add(self, rows):
        frame = self.spark.createDataFrame(rows, self.schema).coalesce(1)
        frame.write.mode("append").parquet(self.folder)

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.folder)


def files_under(path):
    return [p for p in Path(path).rglob("part-*.parquet")]


def test_only_touched_buckets_are_written(spark, tmp_path):
    source = Source(spark, tmp_path / "in")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        microbatch.run_changelog_count(
            source.stream(), ["key"], ["seq"], None, out, checkpoint, buckets=32
        ).awaitTermination()

    rows = [(f"k{n}", moment(n), n) for n in range(2_000)]
    source.add(rows)
    run()
    first = files_under(f"{checkpoint}/carried/version=0")
    assert len({p.parent.name for p in first}) == 32
    whole_size = sum(os.path.getsize(p) for p in first)
    for number in range(1, 5):
        more = [("k7", moment(0), 5_000 + number)]
        rows += more
        source.add(more)
        run()
        written = files_under(f"{checkpoint}/carried/version={number}")
        assert {p.parent.name for p in written} == {written[0].parent.name}
        assert sum(os.path.getsize(p) for p in written) * 8 < whole_size
    # The replaced versions of the bucket are gone, all but the last two.
    bucket = written[0].parent.name
    assert len(list(Path(f"{checkpoint}/carried").glob(f"version=*/{bucket}"))) == 2
    whole = changelog_count(spark.createDataFrame(rows, EVENT), ["key"], ["seq"])
    assert tuples(all_batches(spark, out, whole.schema)) == tuples(whole)


def test_idle_keys_of_a_pattern_end(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(microbatch, "SWEEP", 3)
    source = Source(spark, tmp_path / "in")
    kinds = [Stage("one", F.col("seq") % 2 == 0), Stage("two", F.col("seq") % 2 == 1)]
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    rows = [(f"k{n}", moment(0), n) for n in range(40)]
    for number in range(4):
        part = rows if number == 0 else [("z", moment(100 * number), number)]
        source.add(part)
        microbatch.run_pattern_matches(
            source.stream(), ["key"], ["ts", "seq"], kinds, ["seq"],
            timedelta(hours=1), timedelta(0), out, checkpoint,
        ).awaitTermination()
        held = spark.read.parquet(f"{checkpoint}/carried/manifest/{number}").collect()
        if number < 2:
            assert len(held) > 10
    assert len(held) == 1


def test_timers_end_the_state_of_idle_keys(spark, tmp_path):
    source = Source(spark, tmp_path / "in")
    kinds = [Stage("one", F.col("seq") % 2 == 0), Stage("two", F.col("seq") % 2 == 1)]
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run(rows):
        source.add(rows)
        matches = stream_pattern_matches(
            source.stream(), ["key"], ["ts", "seq"], kinds, ["seq"], within=timedelta(hours=2)
        )
        run_append(matches, out, checkpoint).awaitTermination()
        state = spark.read.format("statestore").option("stateVarName", "newest").load(checkpoint)
        return state.count()

    rows = [(f"k{n % 7}", moment(n / 100), n) for n in range(100)]
    assert run(rows) == 7
    more = [("k1", moment(2.5), 101), ("k2", moment(2.5), 102)]
    assert run(more) == 7
    # The watermark passes all but the new key, also the timers that were set anew.
    assert run([("z", moment(500), 104)]) == 1
    assert run([("z", moment(900), 106), ("z", moment(901), 107)]) == 1
    whole = spark.createDataFrame([*rows, *more, ("z", moment(900), 106), ("z", moment(901), 107)], EVENT)
    expected = pattern_matches(whole, ["key"], ["ts", "seq"], kinds, ["seq"], within=timedelta(hours=2))
    found = spark.read.parquet(out).select("key", "one_seq", "two_seq")
    assert tuples(found) == tuples(expected.select("key", "one.seq", "two.seq")) and found.count() > 50


@pytest.mark.parametrize("within", [None, timedelta(hours=30)])
def test_fresh_matches_are_the_new_ones(spark, within):
    rows = [(f"k{n % 3}", moment(n), n, n % 5 in (1, 3)) for n in range(60)]
    df = spark.createDataFrame(rows, f"{EVENT}, is_new boolean")
    kinds = [Stage(name, F.col("seq") % 4 == k) for k, name in enumerate(("a", "b", "c"))]
    args = (["key"], ["ts", "seq"], kinds, ["seq"])
    names = ["key", "a.seq", "b.seq", "c.seq"]
    every = tuples(pattern_matches(df, *args, within=within).select(*names))
    old = tuples(pattern_matches(df.where("not is_new"), *args, within=within).select(*names))
    fresh = tuples(pattern_matches(df, *args, within=within, fresh="is_new").select(*names))
    assert sorted(old + fresh, key=repr) == every and fresh and old


def count_per_day(stream):
    return windows.tumbling_count(with_watermark(stream, "ts", "1 hour"), "ts", "1 day", ["key"])


def test_open_windows_follow_the_closed_ones(spark, tmp_path):
    source = Source(spark, tmp_path / "in")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    rows = []
    for day in range(3):
        part = [("ab"[n % 2], moment(24 * day + n), n) for n in range(20)]
        rows += part
        source.add(part)
        result = count_per_day(source.stream())
        run_append(result, out, checkpoint).awaitTermination()
        # A flush may be repeated, and the query goes on after it.
        for _ in range(2):
            found = flush.flush(result, out, checkpoint, ["key"], {"cnt": F.col("_0")})
        whole = spark.createDataFrame(rows, EVENT)
        assert tuples(found) == tuples(windows.tumbling_count(whole, "ts", "1 day", ["key"]))
    assert spark.read.parquet(out).count() == 4


def test_an_unfinished_query_is_not_flushed(spark, tmp_path):
    source = Source(spark, tmp_path / "in")
    source.add([("a", moment(1), 1)])
    checkpoint = str(tmp_path / "checkpoint")
    result = count_per_day(source.stream())
    run_append(result, str(tmp_path / "out"), checkpoint).awaitTermination()
    last = max(Path(f"{checkpoint}/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    with pytest.raises(RuntimeError, match="unfinished"):
        flush.open_windows(spark, checkpoint, ["key"], {"cnt": F.col("_0")})


def test_late_and_on_time_rows_are_the_input(spark, tmp_path):
    source = Source(spark, tmp_path / "in")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    parts = {"n": late.Part("count", F.lit(1)), "top": late.Part("max", F.col("seq")), "low": late.Part("min", F.col("seq"))}
    arrivals_of = [
        [("a", moment(1), 1), ("b", moment(30), 2), ("a", None, 3)],
        [("a", moment(2), 4), ("b", moment(25), 5), ("a", moment(60), 6)],
        [("b", moment(47), 7), ("a", moment(49), 8)],
    ]
    for rows in arrivals_of:
        source.add(rows)
        stream = source.stream()
        schema = late.window_schema(stream, "ts", "1 day", ["key"], parts)
        late.run_windows(
            stream, "ts", "1 day", ["key"], parts, "1 hour", out, checkpoint
        ).awaitTermination()
    missed = sorted(row.seq for row in late.late_rows(spark, out, stream.schema).collect())
    assert missed == [3, 4, 7]
    closed, left = late.closed_windows(spark, out, schema), late.open_windows(spark, checkpoint, schema)
    found = closed.unionByName(left)
    on_time = spark.createDataFrame([r for part in arrivals_of for r in part if r[2] not in missed], EVENT)
    expected = windows.tumbling(
        on_time, "ts", "1 day", ["key"], {"n": F.count(F.lit(1)), "top": F.max("seq"), "low": F.min("seq")}
    )
    assert tuples(found) == tuples(expected) and closed.count() == 2 and left.count() == 1


def test_the_queries_over_parts_take_several_micro_batches(spark):
    queries = arrivals.in_parts(
        spark, SF_DIR, lambda stream: stream.writeStream.format("noop").trigger(availableNow=True).start()
    )
    assert len(queries) == arrivals.PARTS
    assert not contract.queries()["parts_late_rows"](spark, SF_DIR).isEmpty()
