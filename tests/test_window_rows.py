"""Functions over a window's rows: order, batches, early ends and odd keys."""

from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import windowrows
from millrace.operators.tablefunctions import register_table_functions
from millrace.operators.windowrows import window_rows
from tests.fixtures import tuples

OUT = T.StructType([T.StructField("first", T.LongType()), T.StructField("n", T.LongType())])


def events(spark, count=5_000):
    rows = [
        ((None, "a", "b")[n % 3], float("nan") if n % 4 == 0 else (None, 1.5)[n % 2], datetime(2024, 1, 1) + timedelta(minutes=n), n)
        for n in range(count)
    ]
    schema = "key string, other double, ts timestamp, seq long"
    return spark.createDataFrame([*rows, ("a", 1.5, None, -1)], schema).repartition(7)


def first_and_count(key, batches):
    seqs = [value for batch in batches for value in batch["seq"].to_pylist()]
    assert seqs == sorted(seqs)
    return [(seqs[0], len(seqs))]


@pytest.mark.parametrize("batch", [3, 1_000])
def test_every_row_once_and_in_order(spark, batch):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = events(spark)
        for keys in (["key"], ["key", "other"], []):
            found = window_rows(df, "ts", "6 hours", keys, ["seq"], first_and_count, OUT)
            expected = (
                df.groupBy(F.window("ts", "6 hours").alias("w"), *keys)
                .agg(F.min("seq").alias("first"), F.count("*").alias("n"))
                .select("w.start", "w.end", *keys, "first", "n")
            )
            # NaN is unlike itself in Python
            assert tuples(found.select([F.col(c).cast("string") for c in found.columns])) == tuples(
                expected.select([F.col(c).cast("string") for c in expected.columns])
            )
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_a_function_may_stop_early_or_return_many(spark):
    def stop(key, batches):
        batch = next(batches)
        return [(value, None) for value in batch["seq"].to_pylist()[:2]]

    df = events(spark, 400)
    found = window_rows(df, "ts", "1 hour", [], ["seq"], stop, OUT).select("first")
    assert tuples(found) == sorted([(60 * h + k,) for h in range(7) for k in (0, 1) if 60 * h + k < 400], key=repr)


def test_windows_are_not_buffered():
    """Batches are asked for one at a time, however long the group."""
    asked = []

    def source():
        for n in range(50):
            asked.append(n)
            yield pa.RecordBatch.from_pydict({"k": [1] * 10, "v": list(range(10))})

    cursor = windowrows._Cursor(source(), ["k"])
    key, rows = next(cursor.groups())
    for seen, _ in enumerate(rows):
        assert len(asked) <= seen + 2
    assert key == (1,) and len(asked) == 50


def test_empty_input(spark):
    assert window_rows(events(spark).limit(0), "ts", "1 hour", [], ["seq"], first_and_count, OUT).count() == 0


def test_json_members(spark):
    register_table_functions(spark)
    rows = [
        (1, '{"a": 1, "b": "x"}'), (2, None), (3, "no json"), (4, "[1]"), (5, "{}"),
        (6, '{"a": 1, "b": "x"}'), (None, '{"c": true, "d": 99999999999999999999}'),
    ]
    spark.createDataFrame(rows, "id long, text string").createOrReplaceTempView("json_texts")
    found = spark.sql("SELECT * FROM json_members(TABLE(SELECT * FROM json_texts))")
    assert tuples(found) == sorted(
        [(1, "a", 1), (1, "b", None), (6, "a", 1), (6, "b", None), (None, "c", None), (None, "d", None)], key=repr
    )
    assert spark.sql("SELECT * FROM json_members(TABLE(SELECT * FROM json_texts WHERE id < 0))").count() == 0
