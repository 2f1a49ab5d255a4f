from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tests import schemas
from millrace.functions import times
from millrace.operators import parse, windows
from millrace.sources import files, generated
from tests import fixtures
from tests.fixtures import tuples


def hour(value):
    return datetime(2020, 12, 16, value)


def test_hourly_counts_per_user(spark):
    df = fixtures.clicks(spark, fixtures.CLICKS_A)
    found = windows.tumbling_count(df, "timestamp", "1 hour", ["user"])
    assert tuples(found, "user", "cnt", "window_start", "window_end") == sorted(
        [
            ("Bob", 1, hour(12), hour(13)),
            ("marry", 1, hour(12), hour(13)),
            ("Liz", 1, hour(13), hour(14)),
            ("marry", 1, hour(13), hour(14)),
            ("Bob", 1, hour(14), hour(15)),
            ("Liz", 1, hour(14), hour(15)),
        ],
        key=repr,
    )


def test_hourly_counts_of_lines(spark):
    clicks = parse.parse_click_lines(
        fixtures.lines(spark, fixtures.CLICK_LINES), fixtures.BASE_DATE
    )
    found = windows.tumbling_count(clicks, "timestamp", "1 hour", ["user"])
    named = found.withColumn("window_end", times.format_seconds(F.col("window_end")))
    assert tuples(named, "window_end", "user", "cnt") == [
        ("2020-12-16 13:00:00", "Bob", 1),
        ("2020-12-16 13:00:00", "marry", 3),
        ("2020-12-16 14:00:00", "Bob", 1),
        ("2020-12-16 14:00:00", "Liz", 2),
        ("2020-12-16 15:00:00", "Bob", 2),
        ("2020-12-16 15:00:00", "Liz", 1),
        ("2020-12-16 15:00:00", "marry", 1),
    ]


def test_the_same_in_sql(spark):
    clicks = parse.parse_click_lines(
        fixtures.lines(spark, fixtures.CLICK_LINES), fixtures.BASE_DATE
    )
    by_function = windows.tumbling_count(clicks, "timestamp", "1 hour", ["user"])
    by_sql = spark.sql(
        "SELECT window.end AS window_end, user, count(url) AS cnt FROM {clicks}"
        " GROUP BY window(timestamp, '1 hour'), user",
        clicks=clicks,
    )
    names = ("window_end", "user", "cnt")
    assert tuples(by_sql, *names) == tuples(by_function, *names)


def test_window_start_offset(spark):
    df = fixtures.clicks(spark, fixtures.CLICKS_A[:1])
    found = windows.tumbling_count(
        df, "timestamp", "1 hour", [], start_time="45 minutes"
    )
    assert tuples(found) == [
        (datetime(2020, 12, 16, 11, 45), datetime(2020, 12, 16, 12, 45), 1)
    ]


def test_several_aggregates(spark, tmp_path):
    df = files.read_csv(spark, fixtures.prices_file(tmp_path), schemas.PRICE)
    df = df.withColumn("ts", times.to_millisecond(F.col("ts6")))
    found = windows.tumbling(
        df,
        "ts",
        "5 seconds",
        [],
        {
            "max_ts": F.max("ts6"),
            "counter": F.count(F.lit(1)),
            "total_price": F.max("price"),
        },
    )
    day = datetime(2019, 12, 12)
    assert tuples(found, "window_end", "max_ts", "counter", "total_price") == sorted(
        [
            (
                day + timedelta(seconds=5),
                day + timedelta(seconds=4, microseconds=4001),
                3,
                Decimal("50.00"),
            ),
            (
                day + timedelta(seconds=10),
                day + timedelta(seconds=6, microseconds=6001),
                2,
                Decimal("5.33"),
            ),
        ],
        key=repr,
    )


def test_arg_max_of_generated_records(spark):
    records = generated.random_records(spark, seed=3)
    found = windows.tumbling_arg_max(records, "ts", "1 second", "key", "seq", ["boy"])
    rows = records.collect()
    expected = {}
    for row in sorted(rows, key=lambda r: r["seq"]):
        start = row["ts"].replace(microsecond=0)
        best = expected.get(start)
        if best is None or row["key"] > best["key"]:
            expected[start] = row
    assert len(expected) == 6
    assert tuples(found, "window_start", "key", "seq", "boy") == sorted(
        [
            (start, row["key"], row["seq"], row["boy"])
            for start, row in expected.items()
        ],
        key=repr,
    )


def test_byte_diffs_per_user_and_window(spark):
    at = [datetime(2024, 1, 1, 0, 0, second) for second in (0, 4, 5, 1)]
    rows = [("a", 10, at[0]), ("a", -25, at[1]), ("a", 7, at[2]), ("b", -1, at[3])]
    df = generated.rows(spark, rows, schemas.EDIT)
    found = windows.tumbling(df, "ts", "5 seconds", ["user"], {"diff": F.sum("byte_diff")})
    assert tuples(found, "user", "window_start", "diff") == [
        ("a", at[0], -15),
        ("a", at[2], 7),
        ("b", at[0], -1),
    ]


def test_keyed_arg_max_ties_keep_the_earlier_row(spark):
    df = spark.createDataFrame(
        [("a", "Z", 2, "late"), ("a", "Z", 1, "early"), ("b", "A", 3, "only")],
        "k string, key string, seq long, tag string",
    ).withColumn("ts", F.timestamp_millis(F.lit(0)))
    found = windows.tumbling_arg_max(df, "ts", "1 second", "key", "seq", ["tag"], ["k"])
    assert tuples(found, "k", "seq", "tag") == [("a", 1, "early"), ("b", 3, "only")]


def test_arg_max_is_combined_before_the_shuffle(spark):
    records = generated.random_records(spark)
    found = windows.tumbling_arg_max(records, "ts", "1 second", "key", "seq", ["boy"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange") :]
    assert "partial_max" in below_exchange


def test_generators(spark):
    assert generated.counter(spark).count() == 1001
    last = generated.counter(spark).orderBy(F.desc("ts")).first()
    assert last["value"] == "1000"
    assert last["ts"] == datetime(1970, 1, 1, 0, 0, 2)
    records = generated.random_records(spark, seed=1)
    assert records.count() == 1002
    assert records.select("key").distinct().count() == 26
    assert records.select("boy").distinct().count() == 5
    assert tuples(records) == tuples(generated.random_records(spark, seed=1))
    kinds = {field.name: field.dataType for field in schemas.KEY_RECORD}
    assert {field.name: field.dataType for field in records.schema} == kinds
    assert tuples(records) != tuples(generated.random_records(spark, seed=2))


def test_values(spark):
    df = generated.values(spark, "(100), (1000), (10000)", ["id"])
    assert tuples(df) == [(100,), (1000,), (10000,)]
