from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import schemas
from millrace.functions import render, text, times
from millrace.operators import parse, relational, rows
from millrace.sources import generated
from tests import fixtures
from tests.fixtures import tuples


def words(spark):
    return generated.rows(
        spark, [("Hello", 1), ("Ciao", 1), ("Hello", 1)], schemas.WORD_FREQUENCY
    )


def test_word_count_of_prose(spark):
    found = relational.grouped_count(
        parse.explode_words(fixtures.lines(spark, fixtures.PROSE), "value"), ["word"], "n"
    )
    counts = dict(found.collect())
    assert len(counts) == 26
    assert sum(counts.values()) == 34
    assert {word: n for word, n in counts.items() if n > 1} == {
        "to": 4,
        "the": 3,
        "or": 2,
        "of": 2,
        "be": 2,
    }


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("a b", ["a", "b"]),
        ("a  b ", ["", "a", "b"]),
        (" a", ["", "a"]),
        ("a   ", ["a"]),
        ("   ", []),
        ("", [""]),
        (None, []),
    ],
)
def test_space_tokens(spark, line, expected):
    found = parse.explode_space_tokens(fixtures.lines(spark, [line]), "value")
    assert sorted(word for (word,) in found.collect()) == sorted(expected)


def test_words_are_ascii_only(spark):
    found = parse.explode_words(fixtures.lines(spark, ["Été d'hiver_1, ..."]), "value")
    assert [word for (word,) in found.collect()] == ["t", "d", "hiver_1"]


def test_sums(spark):
    df = words(spark)
    assert tuples(relational.grouped_sum(df, ["word"], "frequency", "n")) == [
        ("Ciao", 1),
        ("Hello", 2),
    ]
    having = relational.grouped_sum_having(
        df, ["word"], "frequency", "frequency", F.col("frequency") == 2
    )
    assert tuples(having) == [("Hello", 2)]


def test_sum_over_sql_view(spark):
    words(spark).createOrReplaceTempView("wc")
    found = spark.sql("SELECT word, sum(frequency) AS n FROM wc GROUP BY word")
    assert tuples(found) == [("Ciao", 1), ("Hello", 2)]


def test_filtered_sum(spark):
    schema = "name string, country string, revenue bigint"
    df = spark.createDataFrame(
        [("Jack", "FRANCE", 10), ("Rose", "ENGLAND", 30), ("Jack", "FRANCE", 20)], schema
    )
    found = relational.filtered_sum(
        df, F.col("country") == "FRANCE", ["name"], "revenue", "rev_sum"
    )
    assert tuples(found) == [("Jack", 30)]


def test_count_skips_nulls_of_the_counted_column(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", None)], "k string, v string")
    assert tuples(relational.grouped_count(df, ["k"], "n")) == [("a", 2), ("b", 1)]
    assert tuples(relational.grouped_count(df, ["k"], "n", "v")) == [("a", 1), ("b", 0)]


def test_derived_key_sum(spark):
    df = generated.sequences(spark, {"id": (1, 8, "bigint"), "data": (4, 11, "tinyint")})
    found = relational.derived_key_sum(df, "id", 2, "data", above=1)
    assert tuples(found) == [(2, 15), (3, 19), (4, 11)]
    assert found.schema["total"].dataType == T.LongType()
    narrow = relational.derived_key_sum(
        df, "id", 2, "data", above=1, narrow_to="tinyint"
    )
    assert narrow.schema["total"].dataType == T.ByteType()


def test_narrowing_gives_null_where_it_does_not_fit(spark):
    df = spark.createDataFrame([(4, 100), (4, 100)], "id bigint, data int")
    found = relational.derived_key_sum(
        df, "id", 2, "data", above=1, narrow_to="tinyint"
    )
    assert tuples(found) == [(2, None)]


@pytest.mark.parametrize(
    ("values", "mean"),
    [([100, 78], 89.0), ([81, 98], 89.0), ([-3, 0], -1.0), ([7], 7.0), ([None], None)],
)
def test_truncated_mean(spark, values, mean):
    df = spark.createDataFrame([(value,) for value in values], "v bigint")
    assert df.agg(relational.truncated_mean("v")).first()[0] == mean


def test_union_all(spark):
    a = generated.rows(
        spark, [(1, "beer", 3), (1, "diaper", 4), (3, "rubber", 2)], schemas.ORDER_LINE
    )
    b = generated.rows(
        spark, [(2, "pen", 3), (2, "rubber", 3), (4, "beer", 1)], schemas.ORDER_LINE
    )
    found = relational.union_filtered(a, F.col("amount") > 2, b, F.col("amount") < 2)
    assert tuples(found) == [(1, "beer", 3), (1, "diaper", 4), (4, "beer", 1)]


def test_union_keeps_duplicates(spark):
    df = spark.range(3)
    found = relational.union_filtered(df, F.col("id") > 0, df, F.col("id") > 0)
    assert tuples(found) == [(1,), (1,), (2,), (2,)]


def test_projection(spark):
    found = relational.project(words(spark), {"w": "word", "one": F.lit(1)})
    assert tuples(found) == [("Ciao", 1), ("Hello", 1), ("Hello", 1)]


def test_incremental_aggregate(spark):
    df = spark.createDataFrame([("a", 3), ("a", -5), ("b", 1)], "user string, diff int")
    found = relational.incremental_aggregate(
        df,
        ["user"],
        {"total": F.sum("diff"), "n": F.count("diff")},
        {"mean": F.col("total") / F.col("n")},
    )
    assert tuples(found) == [("a", -1.0), ("b", 1.0)]


def test_click_lines(spark):
    extra = ["", "   ", "broken", "Bob 99:99:99 /x", "Bob 12:00:00", "a 1:02:03 /u more"]
    df = fixtures.lines(spark, fixtures.CLICK_LINES + extra + [None])
    clicks = parse.parse_click_lines(df, fixtures.BASE_DATE)
    assert clicks.schema == schemas.CLICK
    assert clicks.count() == 12
    assert ("a", datetime(2020, 12, 16, 1, 2, 3), "/u") in tuples(clicks)
    rejected = parse.rejected_click_lines(df, fixtures.BASE_DATE)
    assert tuples(rejected) == [("Bob 12:00:00",), ("Bob 99:99:99 /x",), ("broken",)]


def test_blank(spark):
    df = spark.createDataFrame([("",), ("  ",), (None,), (" x ",)], "v string")
    assert [row[0] for row in df.select(text.is_not_blank(F.col("v"))).collect()] == [
        False,
        False,
        False,
        True,
    ]


def test_times(spark):
    df = spark.sql("SELECT timestamp'2020-12-16 12:30:30.123987' AS ts")
    found = df.select(
        times.format_seconds(F.col("ts")),
        times.to_millisecond(F.col("ts")),
        times.epoch_millis(F.col("ts")),
        times.shifted(F.col("ts")),
        times.plain_timestamp_text(F.col("ts")),
        times.plain_timestamp_text(F.date_trunc("second", "ts")),
    ).first()
    assert tuple(found) == (
        "2020-12-16 12:30:30",
        datetime(2020, 12, 16, 12, 30, 30, 123000),
        1608121830123,
        datetime(2020, 12, 16, 20, 30, 30, 123987),
        "2020-12-16 12:30:30.123987",
        "2020-12-16 12:30:30.0",
    )


def test_shift_equals_the_time_zone(spark):
    times.register_utc2local(spark)
    found = spark.sql(
        "SELECT utc2local(ts) = from_utc_timestamp(ts, 'Asia/Shanghai') "
        "FROM VALUES (timestamp'2020-12-16 20:30:30') AS t(ts)"
    )
    assert found.first()[0] is True


def test_rendering(spark):
    df = spark.sql(
        "SELECT 'Bob' AS user, timestamp'2020-12-16 12:30:30' AS ts, '/x' AS url, "
        "1 AS id, 'Spark' AS title, 'jack' AS author, 100D AS price, 25 AS qty"
    )
    found = df.select(
        render.click_text(F.col("user"), F.col("ts"), F.col("url")),
        render.key_record_text(F.col("user"), F.lit("Z")),
        render.window_range_text(F.col("ts"), F.col("ts") + F.expr("INTERVAL 1 SECOND")),
        render.book_text(*[F.col(c) for c in ("id", "title", "author", "price", "qty")]),
    ).first()
    assert tuple(found) == (
        "Bob-2020-12-16 12:30:30.0-/x",
        "Bob:Z",
        "1608121830000----1608121831000",
        "1-Spark-jack-100.000000-25",
    )


@pytest.mark.parametrize("open_accumulators", [2, 50_000])
def test_user_defined_aggregate(spark, open_accumulators):
    """The mean of the text lengths, as a total and a count; one key has most rows."""
    df = spark.range(3000).selectExpr(
        "IF(id % 3 > 0, 'hot', IF(id % 7 = 0, NULL, concat('k', id % 50))) AS key",
        "repeat('x', CAST(id % 11 AS INT)) AS text",
    )
    schema = T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField("n", T.LongType()),
            T.StructField("mean", T.DoubleType()),
        ]
    )
    found = rows.aggregate_rows(
        df.repartition(5),
        ["key"],
        lambda: (0, 0),
        lambda acc, row: (acc[0] + len(row["text"]), acc[1] + 1),
        lambda a, b: (a[0] + b[0], a[1] + b[1]),
        lambda key, acc: (*key, acc[1], acc[0] / acc[1]),
        schema,
        open_accumulators=open_accumulators,
    )
    expected = df.groupBy("key").agg(F.count("text"), F.avg(F.length("text")))
    assert tuples(found) == tuples(expected)


def test_user_defined_aggregate_groups_as_group_by_does(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(nan, ["a"]), (nan, ["a"]), (0.0, ["a", "b"]), (-0.0, ["a", "b"]), (None, None), (1.0, [])] * 3,
        "number double, parts array<string>",
    )
    found = rows.aggregate_rows(
        df.repartition(4),
        ["number", "parts"],
        lambda: 0,
        lambda acc, row: acc + 1,
        lambda a, b: a + b,
        lambda key, acc: (*key, acc),
        T.StructType.fromDDL("number double, parts array<string>, n bigint"),
        open_accumulators=2,
    )
    expected = df.groupBy("number", "parts").agg(F.count("*").alias("n"))
    texts = ["cast(number as string)", "cast(parts as string)", "n"]
    assert tuples(found.selectExpr(*texts)) == tuples(expected.selectExpr(*texts))


def test_user_defined_aggregate_per_window(spark):
    df = spark.createDataFrame(
        [("a", 0, 5), ("a", 4, -7), ("a", 6, 1), ("b", 1, 2)], "user string, s int, d int"
    ).withColumn("start", F.window(F.timestamp_seconds("s"), "5 seconds").start)
    schema = T.StructType.fromDDL("start timestamp, user string, total bigint")
    found = rows.aggregate_rows(
        df,
        ["start", "user"],
        lambda: 0,
        lambda acc, row: acc + row["d"],
        lambda a, b: a + b,
        lambda key, acc: (*key, acc),
        schema,
    )
    expected = df.groupBy("start", "user").agg(F.sum("d").alias("total"))
    assert tuples(found) == tuples(expected)


def test_row_functions(spark):
    schema = T.StructType(
        [T.StructField("word", T.StringType()), T.StructField("n", T.IntegerType())]
    )
    df = spark.createDataFrame([("a b",), (None,), ("c",)], "value string")

    def split(row):
        return [(word, 1) for word in (row["value"] or "").split()]

    assert tuples(rows.flat_map_rows(df, split, schema)) == [("a", 1), ("b", 1), ("c", 1)]
    mapped = rows.map_rows(df, lambda row: (row["value"], None), schema)
    assert tuples(mapped) == [("a b", None), ("c", None), (None, None)]
