"""Streams: parity with the batch form, restarts, late rows, reports."""

import itertools
import subprocess
import sys
import time
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import schemas
from millrace.functions import times
from millrace.operators import parse, relational, windows
from millrace.operators.changelog import changelog_count
from millrace.operators.countwindow import count_windows
from millrace.operators.pattern import Stage, pattern_matches
from millrace.operators.relational import truncated_mean
from millrace.sinks.files import rolling_text
from millrace.sources import files, generated
from millrace.streaming import microbatch
from millrace.streaming.run import (
    all_batches,
    appended,
    latest_rows,
    run_append,
    run_latest,
)
from millrace.streaming.stateful import (
    stream_changelog_count,
    stream_count_windows,
    stream_pattern_matches,
)
from millrace.streaming.watermarks import (
    WatermarkLog,
    check_watermarks,
    split_by_wall_clock,
    watermark_violations,
    with_watermark,
)
from tests import fixtures
from tests.fixtures import tuples



def stages():
    return [Stage(name, F.col("name") == name) for name in ("start", "middle", "end")]

EVENT = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("seq", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.LongType()),
    ]
)


def write_lines(folder, name, texts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f"{text}\n" for text in texts))


def click_stream(spark, folder, max_files=None):
    lines = files.stream_text(spark, str(folder), max_files=max_files)
    return parse.parse_click_lines(lines, fixtures.BASE_DATE)


def test_only_closed_windows_appear(spark, tmp_path):
    write_lines(tmp_path / "in", "a.txt", fixtures.CLICK_LINES)
    clicks = with_watermark(click_stream(spark, tmp_path / "in"), "timestamp", "10 seconds")
    counts = windows.tumbling_count(clicks, "timestamp", "1 hour", ["user"])
    found = appended(counts, "clicks").withColumn("end", F.hour("window_end"))
    assert tuples(found, "end", "user", "cnt") == [
        (13, "Bob", 1),
        (13, "marry", 3),
        (14, "Bob", 1),
        (14, "Liz", 2),
    ]


def test_zero_delay_watermark(spark, tmp_path):
    rows = files.stream_csv(spark, fixtures.prices_file(tmp_path), schemas.PRICE)
    rows = with_watermark(
        rows.withColumn("ts", times.to_millisecond(F.col("ts6"))), "ts", "0 seconds"
    )
    found = appended(
        windows.tumbling(rows, "ts", "5 seconds", [], {"n": F.count(F.lit(1))}), "prices"
    )
    assert tuples(found, "window_end", "n") == [(datetime(2019, 12, 12, 0, 0, 5), 3)]


def test_late_rows_are_dropped_and_reported(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "a.txt", ["Bob 12:10:00 /a", "Bob 14:00:00 /b"])
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        clicks = with_watermark(click_stream(spark, source, 1), "timestamp", "10 seconds")
        counts = windows.tumbling_count(clicks, "timestamp", "1 hour", ["user"])
        query = run_append(counts, out, checkpoint)
        query.awaitTermination()
        return query

    run()
    write_lines(source, "b.txt", ["Bob 12:20:00 /late", "Bob 15:30:00 /c"])
    with WatermarkLog(spark) as log:
        report = check_watermarks(log.report(run()))
    assert report.agg(F.sum("late_rows")).first()[0] == 1
    assert report.agg(F.sum("input_rows")).first()[0] == 2
    found = spark.read.parquet(out).withColumn("end", F.hour("window_end"))
    assert tuples(found, "end", "cnt") == [(13, 1), (15, 1)]


def test_watermark_report_finds_a_step_back(spark):
    report = spark.createDataFrame(
        [(0, datetime(2024, 1, 1, 1), 5, 0), (1, datetime(2024, 1, 1, 0), 5, 0)],
        "batch_id long, watermark timestamp, input_rows long, late_rows long",
    )
    assert watermark_violations(report).count() == 1


def test_too_few_watermarks(spark, tmp_path):
    write_lines(tmp_path / "in", "a.txt", fixtures.CLICK_LINES)
    counts = relational.grouped_count(click_stream(spark, tmp_path / "in"), ["user"], "n")
    with WatermarkLog(spark) as log:
        query = run_latest(counts, str(tmp_path / "out"), str(tmp_path / "cp"), "complete")
        query.awaitTermination()
        report = log.report(query)
    assert report.count() == 1
    with pytest.raises(ValueError, match="different watermarks"):
        check_watermarks(report, least_distinct=1)


def test_no_micro_batch_is_missing_from_a_long_report(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(WatermarkLog, "PAGE_ROWS", 50)
    for number in range(120):
        write_lines(tmp_path / "in", f"{number:03}.txt", ["Bob 12:00:00 /a"])
    with WatermarkLog(spark) as log:
        clicks = click_stream(spark, tmp_path / "in", 1)
        query = run_append(clicks, str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
        report = log.report(query)
    assert report.agg(F.sum("input_rows"), F.min("batch_id")).first()[:] == (120, 0)


def test_watermarks_advance_with_the_micro_batches(spark, tmp_path):
    for number in range(3):
        lines = [f"Bob 1{number}:00:00 /a"]
        write_lines(tmp_path / "in", f"{number}.txt", lines)
    clicks = with_watermark(click_stream(spark, tmp_path / "in", 1), "timestamp")
    counts = windows.tumbling_count(clicks, "timestamp", "1 hour", ["user"])
    with WatermarkLog(spark) as log:
        query = run_append(counts, str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
        report = check_watermarks(log.report(query), least_distinct=3)
    assert report.agg(F.max("watermark")).first()[0] == datetime(2020, 12, 16, 12)


def test_running_count_updates(spark, tmp_path):
    write_lines(tmp_path / "in", "a.txt", fixtures.CLICK_LINES[:6])
    write_lines(tmp_path / "in", "b.txt", fixtures.CLICK_LINES[6:])
    counts = relational.grouped_count(
        click_stream(spark, tmp_path / "in", 1), ["user"], "cnt", "url"
    )
    out = str(tmp_path / "out")
    run_latest(counts, out, str(tmp_path / "cp"), "update").awaitTermination()
    found = latest_rows(spark, out, counts.schema, ["user"])
    assert tuples(found) == [("Bob", 4), ("Liz", 3), ("marry", 4)]


def test_append_refuses_updating_results(spark, tmp_path):
    write_lines(tmp_path / "in", "a.txt", fixtures.CLICK_LINES)
    counts = relational.grouped_count(click_stream(spark, tmp_path / "in"), ["user"], "n")
    with pytest.raises(AnalysisException, match="UNSUPPORTED_OPERATION"):
        run_append(counts, str(tmp_path / "out"), str(tmp_path / "cp"))


def test_wall_clock(spark):
    df = spark.sql(
        "SELECT ts FROM VALUES (current_timestamp()), (timestamp'2020-01-01'), "
        "(CAST(NULL AS TIMESTAMP)) AS t(ts)"
    )
    on_time, late = split_by_wall_clock(df, "ts", "5 SECONDS")
    assert (on_time.count(), late.count()) == (1, 2)


def test_processing_time_windows(spark, tmp_path):
    write_lines(tmp_path / "in", "a.txt", fixtures.PROSE)
    lines = files.stream_text(spark, str(tmp_path / "in"))
    tokens = parse.explode_space_tokens(lines, "value")
    sums = windows.processing_time_sum(tokens, "3 seconds", ["word"], F.lit(1), "n")
    out = str(tmp_path / "out")
    run_latest(sums, out, str(tmp_path / "cp"), "update").awaitTermination()
    found = latest_rows(spark, out, sums.schema, ["window_start", "window_end", "word"])
    assert dict(tuples(found, "word", "n"))["to"] == 3
    width = found.select(F.col("window_end") - F.col("window_start")).distinct().collect()
    assert [row[0] for row in width] == [timedelta(seconds=3)]


def test_rolling_sink(spark, tmp_path):
    write_lines(tmp_path / "in", "a.txt", fixtures.CLICK_LINES)
    lines = files.stream_text(spark, str(tmp_path / "in"))
    out = tmp_path / "out"
    rolling_text(
        lines,
        F.col("value"),
        str(out),
        str(tmp_path / "cp"),
        interval=None,
        max_records_per_file=4,
    ).awaitTermination()
    buckets = [path for path in out.iterdir() if path.name.startswith("bucket=")]
    assert all(len(path.name) == len("bucket=2020-12-16--12") for path in buckets)
    assert sum(len(list(path.glob("*.txt"))) for path in buckets) == 3
    found = spark.read.schema("value string, bucket string").text(str(out))
    assert tuples(found, "value") == sorted((line,) for line in fixtures.CLICK_LINES)


def test_streamed_ids_feed_the_generators(spark):
    records = generated.with_random_record(generated.stream_ids(spark, 10), seed=1)
    assert records.isStreaming
    assert records.columns == ["boy", "key", "ts", "seq"]


def keyed_events():
    names = ["start", "middle", "end", "start", "end", "middle", "end", "other"]
    rows = []
    for seq in range(160):
        at = datetime(2024, 1, 1) + timedelta(hours=seq)
        key = "hot" if seq % 3 else f"k{seq % 4}"
        rows.append((key, at, seq, names[(seq * 5 + seq // 7) % len(names)], seq % 11 - 5))
    return rows


@pytest.fixture
def in_two_runs(spark, tmp_path):
    """Runs a query over a first file, stops, and goes on with two more."""
    rows = keyed_events()
    source = str(tmp_path / "in")

    def add(part):
        spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(source)

    def run(begin):
        out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

        def stream():
            reader = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1)
            return reader.parquet(source)

        add(rows[:50])
        begin(stream(), out, checkpoint).awaitTermination()
        add(rows[50:51])
        begin(stream(), out, checkpoint).awaitTermination()
        add(rows[51:])
        begin(stream(), out, checkpoint).awaitTermination()
        return out

    return spark.createDataFrame(rows, EVENT), run


def test_stateful_changelog_survives_restarts(spark, in_two_runs):
    whole, run = in_two_runs
    out = run(
        lambda stream, out, checkpoint: run_append(
            stream_changelog_count(stream, ["key"], ["seq"]), out, checkpoint
        )
    )
    expected = changelog_count(whole, ["key"], ["seq"]).drop("seq")
    assert tuples(spark.read.parquet(out)) == tuples(expected)


def test_stateful_count_windows_survive_restarts(spark, in_two_runs):
    whole, run = in_two_runs
    out = run(
        lambda stream, out, checkpoint: run_append(
            stream_count_windows(stream, ["key"], ["seq"], 4, "value"), out, checkpoint
        )
    )
    assert tuples(spark.read.parquet(out)) == tuples(windows_of(whole))


def windows_of(whole):
    return count_windows(
        whole,
        ["key"],
        ["seq"],
        4,
        {"total": F.sum("value"), "mean": truncated_mean("value")},
    )


def test_stateful_pattern_survives_restarts(spark, in_two_runs):
    whole, run = in_two_runs
    within = timedelta(hours=20)
    out = run(
        lambda stream, out, checkpoint: run_append(
            stream_pattern_matches(
                stream, ["key"], ["ts", "seq"], stages(), ["seq", "ts"], within=within
            ),
            out,
            checkpoint,
        )
    )
    found = spark.read.parquet(out).select("key", "start_seq", "middle_seq", "end_seq")
    assert tuples(found) == tuples(matches_of(whole, within))
    assert found.count() > 50


def matches_of(whole, within):
    return pattern_matches(
        whole, ["key"], ["ts", "seq"], stages(), ["seq"], within=within
    ).select("key", "start.seq", "middle.seq", "end.seq")


@pytest.mark.parametrize("max_rows", [10**6, 9])
def test_changelog_steps_survive_restarts(spark, in_two_runs, max_rows):
    whole, run = in_two_runs
    out = run(
        lambda stream, out, checkpoint: microbatch.run_changelog_count(
            stream, ["key"], ["seq"], None, out, checkpoint, max_rows=max_rows
        )
    )
    expected = changelog_count(whole, ["key"], ["seq"])
    assert tuples(all_batches(spark, out, expected.schema)) == tuples(expected)


@pytest.mark.parametrize("max_rows", [10**6, 9])
def test_count_window_steps_survive_restarts(spark, in_two_runs, max_rows):
    whole, run = in_two_runs
    out = run(
        lambda stream, out, checkpoint: microbatch.run_count_windows(
            stream, ["key"], ["seq"], 4, "value", out, checkpoint, max_rows=max_rows
        )
    )
    expected = windows_of(whole)
    assert tuples(all_batches(spark, out, expected.schema)) == tuples(expected)


@pytest.mark.parametrize("max_rows", [10**6, 9])
def test_pattern_steps_survive_restarts(spark, in_two_runs, max_rows):
    whole, run = in_two_runs
    within = timedelta(hours=20)
    out = run(
        lambda stream, out, checkpoint: microbatch.run_pattern_matches(
            stream,
            ["key"],
            ["ts", "seq"],
            stages(),
            ["seq"],
            within,
            timedelta(0),
            out,
            checkpoint,
            max_rows=max_rows,
        )
    )
    found = spark.read.parquet(out).select("key", "start.seq", "middle.seq", "end.seq")
    assert tuples(found) == tuples(matches_of(whole, within))


@pytest.mark.parametrize("form", ["steps", "stateful"])
def test_patterns_in_any_order_of_arrival(spark, tmp_path, form):
    rows = [
        ("k", 1, 1, "start", 1), ("k", 2, 2, "middle", 1), ("k", 3, 3, "end", 1),
        ("k", 4, 4, "middle", 1), ("k", 5, 5, "end", 1), (None, 1, 1, "start", 1),
        (None, 2, 2, "middle", 1), (None, 3, 3, "end", 1), ("k", None, 9, "end", 1),
    ]
    schema = "key string, hour int, seq long, kind string, value int"
    day = F.lit("2024-01-01 00:00:00").cast("timestamp")
    whole = spark.createDataFrame(rows, schema).withColumn(
        "ts", day + F.make_interval(hours=F.col("hour"))
    )
    kinds = [Stage(kind, F.col("kind") == kind) for kind in ("start", "middle", "end")]
    keys, order, within = ["key"], ["ts", "seq"], timedelta(hours=20)
    expected = pattern_matches(whole, keys, order, kinds, ["seq"], within=within).select(
        "start.seq", "middle.seq", "end.seq"
    )
    assert expected.count() == 3
    for number, order_of_arrival in enumerate([(4, 2, 1, 0, 3), (2, 0, 4, 1, 3)]):
        base = tmp_path / f"{form}-{number}"
        for place, position in enumerate([*order_of_arrival, 5, 6, 7, 8]):
            one = whole.where((F.col("seq") == rows[position][2]) & F.col("key").eqNullSafe(rows[position][0]))
            one.coalesce(1).write.mode("append").json(f"{base}/in/{place}")
            time.sleep(0.02)
        stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).json(f"{base}/in/*")
        out, checkpoint = f"{base}/out", f"{base}/cp"
        if form == "steps":
            query = microbatch.run_pattern_matches(
                stream, keys, order, kinds, ["seq"], within, timedelta(hours=20), out, checkpoint
            )
            names = ["start.seq", "middle.seq", "end.seq"]
        else:
            matches = stream_pattern_matches(
                stream, keys, order, kinds, ["seq"], within=within, lateness=timedelta(hours=20)
            )
            query = run_append(matches, out, checkpoint)
            names = ["start_seq", "middle_seq", "end_seq"]
        query.awaitTermination()
        assert tuples(spark.read.parquet(out).select(*names)) == tuples(expected)


def test_a_failed_micro_batch_is_repeated(spark, in_two_runs, monkeypatch):
    """The second run fails after writing its result and before carrying its state."""
    whole, run = in_two_runs
    step = microbatch.changelog.changelog_count_step
    attempts = []

    def failing_once(rows, before, *args, **options):
        attempts.append(rows)
        result, after = step(rows, before, *args, **options)
        if len(attempts) == 2:
            broken = F.raise_error(F.lit("lost")).cast("bigint")
            after = after.withColumn("_step", broken)
        return result, after

    monkeypatch.setattr(microbatch.changelog, "changelog_count_step", failing_once)

    class Tolerant:
        def __init__(self, stream, out, checkpoint):
            self.query = microbatch.run_changelog_count(
                stream, ["key"], ["seq"], None, out, checkpoint
            )

        def awaitTermination(self):
            try:
                self.query.awaitTermination()
            except StreamingQueryException as failure:
                assert "lost" in str(failure)

    out = run(Tolerant)
    assert len(attempts) == 4
    expected = changelog_count(whole, ["key"], ["seq"])
    assert tuples(all_batches(spark, out, expected.schema)) == tuples(expected)


def test_executors_need_no_installed_package(tmp_path):
    from pyspark import cloudpickle

    from millrace.streaming import stateful

    pickled = cloudpickle.dumps(stateful._ChangelogCount(["k"], ["k"], ["k"], "cnt"))
    code = "import pickle, sys; print(type(pickle.load(sys.stdin.buffer)).__name__)"
    loaded = subprocess.run(
        [sys.executable, "-c", code],
        input=pickled,
        cwd=tmp_path,
        capture_output=True,
        check=True,
    )
    assert loaded.stdout.strip() == b"_ChangelogCount"


def test_long_chains_come_in_pieces(monkeypatch):
    import numpy as np

    from millrace.streaming import stateful

    monkeypatch.setattr(stateful, "ROW_LIMIT", 3)
    starts, middles = np.array([0, 2, 4, 5]), np.array([1, 3, 6, 7])
    for low in (0, 2, 5):
        chains = np.array([[8]]), np.array([low])
        pieces = list(stateful._extended(*chains, [starts, middles]))
        found = sorted(tuple(map(int, row)) for piece in pieces for row in piece)
        expected = sorted(
            (s, m, 8) for s, m in itertools.product(starts, middles) if low <= s < m < 8
        )
        assert found == expected
        assert max(len(piece) for piece in pieces) <= 4
