"""Files that roll by bytes: limits, repeated micro-batches, restarts."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.sinks import rolling
from millrace.sources import files


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


def run(spark, tmp_path, **options):
    stream = files.stream_text(spark, str(tmp_path / "in"))
    query = rolling.rolling_files(
        stream,
        F.col("value"),
        str(tmp_path / "out"),
        str(tmp_path / "cp"),
        interval=None,
        **options,
    )
    query.awaitTermination()
    return query


def parts(tmp_path, pattern="bucket=*/*"):
    return sorted((tmp_path / "out").glob(pattern))


def lines_of(tmp_path):
    return sorted(line for part in parts(tmp_path) for line in part.read_text().splitlines())


def test_no_file_is_above_the_limit(spark, tmp_path):
    lines = [f"{k:05d} " + "x" * (k % 50) for k in range(3000)]
    put(tmp_path / "in", "a.txt", lines)
    run(spark, tmp_path, max_bytes=1000, prefix="prefix", suffix=".log")
    assert lines_of(tmp_path) == sorted(lines)
    sizes = [part.stat().st_size for part in parts(tmp_path)]
    assert max(sizes) <= 1000
    # Files are full: the next line would not have fitted in any but the last of a task.
    assert sum(size < 1000 - 57 for size in sizes) <= 8
    assert all(re.fullmatch(r"prefix-\w{8}-0-\d{5}\.log", part.name) for part in parts(tmp_path))
    assert all(re.fullmatch(r"bucket=\d{4}-\d\d-\d\d--\d\d", part.parent.name) for part in parts(tmp_path))
    assert not list((tmp_path / "out" / "_staged").iterdir())


def test_a_long_line_has_its_own_file(spark, tmp_path):
    put(tmp_path / "in", "a.txt", ["a", "b" * 100, "", "c", "ü" * 5])
    run(spark, tmp_path, max_bytes=11, bucket=F.lit("all"))
    assert lines_of(tmp_path) == sorted(["a", "b" * 100, "", "c", "ü" * 5])
    over = [part for part in parts(tmp_path) if part.stat().st_size > 11]
    assert [part.read_text() for part in over] == ["b" * 100 + "\n"]


def test_runs_go_on_where_they_ended(spark, tmp_path):
    for number in range(3):
        put(tmp_path / "in", f"{number}.txt", [f"{number} {k}" for k in range(10)])
        run(spark, tmp_path, max_bytes=16)
    assert lines_of(tmp_path) == sorted(f"{n} {k}" for n in range(3) for k in range(10))
    assert len(list((tmp_path / "out" / "_rolled").glob("*/*"))) == 1


@pytest.mark.parametrize("moved", ["all", "some", "none"])
def test_a_repeated_micro_batch_adds_nothing(spark, tmp_path, moved):
    lines = [f"line {k}" for k in range(40)]
    put(tmp_path / "in", "a.txt", lines)
    run(spark, tmp_path, max_bytes=64)
    # As if the driver was lost after the log entry: Spark has not noted the commit, and
    # files are still where the tasks staged them.
    entry = next((tmp_path / "out" / "_rolled").glob("*/*"))
    moves = rolling.json.loads(entry.read_text())
    for staged, final in moves[: {"all": 0, "some": 3, "none": len(moves)}[moved]]:
        system, _ = rolling._resolve(str(tmp_path))
        system.create_dir(staged.rpartition("/")[0])
        system.move(final, staged)
    (tmp_path / "cp" / "commits" / "0").unlink()
    (tmp_path / "cp" / "commits" / ".0.crc").unlink(missing_ok=True)
    run(spark, tmp_path, max_bytes=64)
    assert lines_of(tmp_path) == sorted(lines)


def test_a_lost_task_leaves_nothing(spark, tmp_path):
    put(tmp_path / "in", "a.txt", ["1", "2", "bad"])
    stream = files.stream_text(spark, str(tmp_path / "in"))
    line = F.when(F.col("value") == "bad", F.raise_error(F.lit("bad"))).otherwise(F.col("value"))
    query = rolling.rolling_files(stream, line, str(tmp_path / "out"), str(tmp_path / "cp"), interval=None)
    with pytest.raises(Exception, match="bad"):
        query.awaitTermination()
    assert not parts(tmp_path)
    run(spark, tmp_path)  # without the fault the same checkpoint goes on
    assert lines_of(tmp_path) == ["1", "2", "bad"]


def test_buckets_of_any_name(spark, tmp_path):
    names = ["a/b", "a b", "", "ü", "x=1", "%", *map(str, range(rolling.MOST_OPEN))]
    put(tmp_path / "in", "a.txt", [f"{name},{k}" for k in range(5) for name in names])
    bucket = F.split("value", ",")[0]
    run(spark, tmp_path, bucket=F.when(bucket != "", bucket))
    found = spark.read.schema("value string, bucket string").text(str(tmp_path / "out"))
    rows = {(row.bucket or "", row.value) for row in found.collect()}
    assert rows == {(name, f"{name},{k}") for k in range(5) for name in names}
    assert found.count() == 5 * len(names)


def test_two_queries_share_a_folder_but_no_checkpoint_is_reused(spark, tmp_path):
    put(tmp_path / "in", "a.txt", ["1", "2"])
    run(spark, tmp_path)
    stream = files.stream_text(spark, str(tmp_path / "in"))
    again = (stream, F.col("value"), str(tmp_path / "out"))
    rolling.rolling_files(*again, str(tmp_path / "cp2"), interval=None).awaitTermination()
    assert lines_of(tmp_path) == ["1", "1", "2", "2"]
    (tmp_path / "cp" / "metadata").unlink()
    with pytest.raises(ValueError, match="checkpoint that is gone"):
        rolling.rolling_files(*again, str(tmp_path / "cp"), interval=None)


def test_the_limit_is_positive(spark, tmp_path):
    put(tmp_path / "in", "a.txt", ["1"])
    with pytest.raises(ValueError, match="positive"):
        run(spark, tmp_path, max_bytes=0)
