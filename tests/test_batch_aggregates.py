"""Aggregates over Arrow batches against plain Python."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.batchaggregates import Fold, aggregate_batches


def _add(states, codes, batch):
    value = batch["value"].to_numpy()
    np.bitwise_xor.at(states["xor"], codes, value)
    np.maximum.at(states["top"], codes, value)
    np.add.at(states["by_digit"], (codes, value % 10), 1)


def _merge(states, codes, others):
    np.bitwise_xor.at(states["xor"], codes, others["xor"])
    np.maximum.at(states["top"], codes, others["top"])
    np.add.at(states["by_digit"], codes, others["by_digit"])


def _finish(states):
    return [states["xor"], states["top"], states["by_digit"].argmax(axis=1), states["by_digit"].sum(axis=1)]


FOLD = Fold(
    {"xor": np.int64(0), "top": np.int64(-1), "by_digit": np.zeros(10, np.int64)}, _add, _merge, _finish
)
RESULT = T.StructType([T.StructField(name, T.LongType()) for name in ("x", "highest", "digit", "n")])


def group(key):
    return tuple("NaN" if isinstance(part, float) and math.isnan(part) else part for part in key)


@pytest.mark.parametrize("held_bytes", [1, 20_000, 64 << 20])
def test_keys_of_all_kinds(spark, held_bytes):
    """Small bounds send accumulators to the shuffle early; a third of the rows has one key."""
    random.seed(5)
    rows = []
    for n in range(5000):
        name = "hot" if n % 3 == 0 else random.choice(["", "é", None, "a b", f"k{n % 700}"])
        number = 1.5 if n % 3 == 0 else random.choice([0.0, -0.0, math.nan, None, 2.5])
        rows.append((name, number, random.randrange(10**9), "other"))
    df = spark.createDataFrame(rows, "name string, number double, value long, extra string").repartition(7)
    found = aggregate_batches(df, ["name", "number"], FOLD, RESULT, held_bytes=held_bytes)
    assert found.columns == ["name", "number", "x", "highest", "digit", "n"]
    expected = defaultdict(list)
    for name, number, value, _ in rows:
        expected[group((name, number))].append(value)
    got = {group(row[:2]): tuple(row[2:]) for row in found.collect()}
    assert found.count() == len(got) == len(expected)
    for key, values in expected.items():
        digits = [sum(value % 10 == d for value in values) for d in range(10)]
        x = 0
        for value in values:
            x ^= value
        assert got[key] == (x, max(values), digits.index(max(digits)), len(values))


def test_a_key_over_several_batches(spark):
    """Each task sends an accumulator for a key; behind the shuffle batches hold one row."""
    df = spark.range(400).select((F.col("id") % 3).alias("k"), F.col("id").alias("value")).repartition(40)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        rows = aggregate_batches(df, ["k"], FOLD, RESULT).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {row.k: (row.n, row.highest) for row in rows} == {0: (134, 399), 1: (133, 397), 2: (133, 398)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "k date, value long")
    assert aggregate_batches(df, ["k"], FOLD, RESULT).collect() == []


def test_what_is_refused(spark):
    df = spark.createDataFrame([([1], 1)], "k array<int>, value long")
    with pytest.raises(TypeError, match="nested"):
        aggregate_batches(df, ["k"], FOLD, RESULT)
    with pytest.raises(ValueError, match="one key"):
        aggregate_batches(df, [], FOLD, RESULT)
    with pytest.raises(ValueError, match="name"):
        aggregate_batches(df.withColumn("Top", F.lit(1)), ["Top"], FOLD, RESULT)
