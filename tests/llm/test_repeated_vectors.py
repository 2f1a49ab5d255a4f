"""Neighbours of tables whose rows are repeated next to each other."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.llm import blockknn


@pytest.mark.parametrize("copies", [2, 10])
def test_repeated_rows_take_no_places(spark, copies):
    listed = [(0, [1.0, 0.0])] + [(1, [1.0, 0.1])] * copies + [(k, [1.0, float(k)]) for k in range(2, 30)]
    # One id with two vectors as far from the query is two rows.
    listed += [(2, [1.0, -2.0])]
    vectors = spark.createDataFrame(listed, "vec_id long, embedding array<float>").coalesce(1)
    got = blockknn.nearest(vectors, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 11))
    assert [r.vec_id for r in got] == [1, 2, 2, 3, 4, 5, 6, 7, 8, 9]
