"""Table queries, each with the SQL that gives the same rows."""

from __future__ import annotations

import json
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import render, text, times
from millrace.operators import parse, relational, rows, windows
from millrace.operators.changelog import changelog_count
from millrace.operators.countwindow import count_windows
from millrace.operators.pattern import (
    Stage,
    match_map,
    pattern_counts,
    pattern_matches,
)
from millrace.plans.tables import table
from millrace.sources import generated
from millrace.streaming.watermarks import split_by_wall_clock

BASE_DATE = "2020-12-16"
ONE_DAY = timedelta(days=1)
FUNNEL = ("signup", "view", "purchase")


def funnel_stages() -> list[Stage]:
    return [Stage(name, F.col("event_type") == name) for name in FUNNEL]


def edits(events: DataFrame) -> DataFrame:
    """The events as edits with a signed size."""
    return events.select(
        F.col("user_id"),
        (F.floor("value") - 50).cast("int").alias("byte_diff"),
        F.col("ts"),
    )


def click_lines(events: DataFrame) -> DataFrame:
    """The events as ``user time url`` text; error events lack the time."""
    time_of_day = F.date_format("ts", "HH:mm:ss")
    url = F.concat(F.lit("/"), F.col("event_type"), F.lit(".html"))
    full = F.concat_ws(" ", F.col("user_id").cast("string"), time_of_day, url)
    short = F.concat_ws(" ", F.col("user_id").cast("string"), url)
    return events.select(
        F.when(F.col("event_type") == "error", short).otherwise(full).alias("value")
    )


def whole(column: str) -> Column:
    return F.floor(F.col(column)).cast("bigint")


def tumble_count_user_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return windows.tumbling_count(events, "ts", "1 hour", ["user_id"])


def tumble_multi_agg_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn(
        "ts3", times.to_millisecond(F.col("ts")).cast("timestamp_ntz")
    )
    price = F.col("value").cast("decimal(10,2)")
    return windows.tumbling(
        events,
        "ts3",
        "5 minutes",
        [],
        {
            "max_ts": F.max("ts"),
            "counter": F.count(F.lit(1)),
            "total_price": F.max(price).cast("double"),
        },
    ).drop("window_start")


def window_argmax_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return windows.tumbling_arg_max(
        events, "ts", "1 hour", "value", "event_id", ["user_id"]
    )


def window_argmax_user_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    best = windows.tumbling_arg_max(
        events, "ts", "1 day", "event_type", "event_id", ["value"], ["user_id"]
    )
    return best.select(
        render.window_range_text(F.col("window_start"), F.col("window_end")).alias(
            "window_range"
        ),
        "user_id",
        "event_id",
        render.key_record_text(F.col("user_id"), F.col("event_type")).alias("record"),
    )


def edit_size_user_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    summed = relational.incremental_aggregate(
        edits(table(spark, sf_dir, "events")),
        [F.window("ts", "5 seconds").alias("window"), "user_id"],
        {"diff": F.sum("byte_diff")},
        {"byte_diff": F.col("diff")},
    )
    return summed.select(F.col("window.end").alias("window_end"), "user_id", "byte_diff")


def edit_size_user_defined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sums per hour, by an aggregate written in Python."""
    keyed = edits(table(spark, sf_dir, "events")).select(
        F.window("ts", "1 hour").start.alias("window_start"), "user_id", "byte_diff"
    )
    schema = keyed.select("window_start", "user_id").schema.add("diff", T.LongType())
    return rows.aggregate_rows(
        keyed,
        ["window_start", "user_id"],
        lambda: 0,
        lambda total, row: total + row["byte_diff"],
        lambda a, b: a + b,
        lambda key, total: (*key, total),
        schema,
    )


def props_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and values of the JSON text, by a row function written in Python."""
    events = table(spark, sf_dir, "events").select("event_id", "props")
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("name", T.StringType()),
            T.StructField("number", T.LongType()),
        ]
    )

    def pairs(row: dict) -> list[tuple]:
        return [
            (row["event_id"], name, number)
            for name, number in json.loads(row["props"]).items()
        ]

    return rows.flat_map_rows(events, pairs, schema)


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = parse.explode_words(table(spark, sf_dir, "documents"), "text")
    return relational.grouped_count(words, ["word"], "frequency")


def space_token_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = parse.explode_space_tokens(table(spark, sf_dir, "documents"), "text")
    ones = relational.project(tokens, {"word": "word", "one": F.lit(1)})
    return relational.grouped_sum(ones, ["word"], "one", "frequency")


def grouped_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return relational.grouped_sum(
        lines, ["l_returnflag", "l_linestatus"], whole("l_quantity"), "quantity"
    )


def grouped_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return relational.grouped_count(events, ["event_type"], "cnt")


def group_sum_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return relational.grouped_sum_having(
        events, ["user_id"], F.lit(1), "frequency", F.col("frequency") == 60
    )


def filter_group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    summed = relational.filtered_sum(
        orders,
        F.col("o_orderstatus") == "F",
        ["o_custkey"],
        F.col("o_totalprice").cast("decimal(18,2)"),
        "rev_sum",
    )
    return summed.withColumn("rev_sum", F.col("rev_sum").cast("double"))


def union_all_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = relational.project(
        table(spark, sf_dir, "customer"),
        {"id": "c_custkey", "name": "c_name", "amount": "c_acctbal"},
    )
    suppliers = relational.project(
        table(spark, sf_dir, "supplier"),
        {"id": "s_suppkey", "name": "s_name", "amount": "s_acctbal"},
    )
    return relational.union_filtered(
        customers, F.col("amount") > 5000, suppliers, F.col("amount") < 1000
    )


def derived_key_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return relational.derived_key_sum(lines, "l_orderkey", 2, "l_linenumber", above=1)


def renamed_with_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return relational.project(
        orders,
        {"word": "o_orderpriority", "one": F.lit(1), "order_id": "o_orderkey"},
    )


def non_blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.split("text", "\n")).alias("line")
    )
    kept = lines.where(text.is_not_blank(F.col("line")))
    return relational.grouped_count(kept, ["doc_id"], "lines")


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = click_lines(table(spark, sf_dir, "events"))
    clicks = parse.parse_click_lines(lines, BASE_DATE)
    return clicks.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = click_lines(table(spark, sf_dir, "events"))
    return parse.rejected_click_lines(lines, BASE_DATE)


def rendered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    url = F.concat(F.lit("/"), F.col("event_type"))
    return events.select(
        F.col("event_id").cast("string").alias("id_text"),
        render.click_text(F.col("user_id"), F.col("ts"), url).alias("click"),
        times.format_seconds(F.col("ts")).alias("seconds"),
        times.epoch_millis(F.col("ts")).alias("millis"),
        times.from_epoch_millis(times.epoch_millis(F.col("ts")))
        .cast("timestamp_ntz")
        .alias("ts3"),
    )


def utc2local(spark: SparkSession, sf_dir: str) -> DataFrame:
    times.register_utc2local(spark)
    return spark.sql(
        "SELECT event_id, CAST(utc2local(CAST(ts AS TIMESTAMP)) AS TIMESTAMP_NTZ)"
        " AS local_ts FROM {events}",
        events=table(spark, sf_dir, "events"),
    )


def wall_clock_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    clock = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    on_time, late = split_by_wall_clock(events, "ts", "5 DAYS", clock)
    return on_time.withColumn("late", F.lit(False)).unionAll(
        late.withColumn("late", F.lit(True))
    )


def count_window_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_id", whole("value").alias("score")
    )
    return count_windows(
        events,
        ["user_id"],
        ["event_id"],
        2,
        {"total": F.sum("score"), "mean": relational.truncated_mean("score")},
    )


def gappy(events: DataFrame) -> DataFrame:
    """Scores of which every third is missing, and all of some users."""
    gap = (F.col("event_id") % 3 == 0) | (F.col("user_id") % 5 == 0)
    return events.select(
        "user_id", "event_id", F.when(~gap, whole("value")).alias("score")
    )


def count_window_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_windows(
        gappy(table(spark, sf_dir, "events")),
        ["user_id"],
        ["event_id"],
        2,
        {"total": F.sum("score").cast("double"), "mean": relational.truncated_mean("score")},
    )


def changelog_count_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return changelog_count(events, ["user_id"], ["event_id"], "event_type")


def changelog_count_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("url"),
    )
    return changelog_count(events, ["user_id"], ["event_id"], "url")


def _funnel(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    return pattern_matches(
        table(spark, sf_dir, "events"),
        ["user_id"],
        ["ts", "event_id"],
        funnel_stages(),
        columns,
        within=ONE_DAY,
    )


def pattern_signup_view_purchase_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = _funnel(spark, sf_dir, ["event_id"])
    return matches.select(
        "user_id",
        *[F.col(f"{stage}.event_id").alias(f"{stage}_id") for stage in FUNNEL],
    )


def pattern_match_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = _funnel(spark, sf_dir, ["event_id", "event_type"])
    return matches.select(
        "user_id",
        render.match_text(
            match_map(funnel_stages()), FUNNEL, ["event_id", "event_type"]
        ).alias("match"),
    )


def pattern_match_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = pattern_counts(
        table(spark, sf_dir, "events"), ["user_id"], ["event_id"], funnel_stages()
    )
    # As text: the exact number outgrows 64 bits on large tables.
    return counts.withColumn("matches", F.col("matches").cast("string"))


def json_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k int").k.alias("k"))


def datagen_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = (
        table(spark, sf_dir, "orders")
        .agg(F.min("o_orderkey"), F.max("o_orderkey"))
        .first()
    )
    return generated.sequences(
        spark,
        {"id": (first, last, "bigint"), "data": (first + 3, last + 3, "bigint")},
    )


def generated_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = generated.with_counter(table(spark, sf_dir, "events"), "event_id")
    return counted.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def generated_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = generated.with_random_record(
        table(spark, sf_dir, "events"), "event_id", seed=7
    )
    return records.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def generated_random_argmax_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling_arg_max(
        generated_random(spark, sf_dir), "ts", "1 second", "key", "seq", ["boy"]
    )


QUERIES = {
    function.__name__: function
    for function in (
        tumble_count_user_1h,
        tumble_multi_agg_5m,
        window_argmax_1h,
        window_argmax_user_1d,
        edit_size_user_5s,
        edit_size_user_defined,
        props_by_row,
        word_count,
        space_token_sum,
        grouped_sum,
        grouped_count,
        group_sum_having,
        filter_group_sum,
        union_all_filtered,
        derived_key_sum,
        renamed_with_constant,
        non_blank_lines,
        parsed_lines,
        rejected_lines,
        rendered_records,
        utc2local,
        wall_clock_split,
        count_window_2,
        count_window_nulls,
        changelog_count_user,
        changelog_count_nulls,
        pattern_signup_view_purchase_1d,
        pattern_match_text,
        pattern_match_count,
        json_decoded,
        generated_counter,
        generated_random,
        generated_random_argmax_1s,
    )
}

_CLICK_LINES = """
    SELECT CASE WHEN event_type = 'error'
                THEN user_id || ' /' || event_type || '.html'
                ELSE user_id || ' ' || strftime(ts, '%H:%M:%S') || ' /' || event_type
                     || '.html' END AS line,
           event_type, user_id, ts
    FROM events"""

_FUNNEL = """
    FROM events s
    JOIN events v ON v.user_id = s.user_id AND v.event_id > s.event_id
    JOIN events p ON p.user_id = s.user_id AND p.event_id > v.event_id
    WHERE s.event_type = 'signup' AND v.event_type = 'view'
      AND p.event_type = 'purchase'"""

_RANDOM = """
    SELECT event_id,
           ((((event_id + 7) % 2147483647) * 48271 + 1) % 2147483647 * 48271 + 1)
             % 2147483647 % 5 AS boy_number,
           ((((event_id + 1000010) % 2147483647) * 48271 + 1) % 2147483647 * 48271 + 1)
             % 2147483647 % 26 AS key_number
    FROM events"""

_RECORDS = f"""
    SELECT 'boy-' || chr((65 + boy_number)::INTEGER) AS boy,
           chr((65 + key_number)::INTEGER) AS key,
           make_timestamp(event_id * 5000) AS ts, event_id AS seq
    FROM ({_RANDOM})"""

_CHANGES = """
    WITH c AS (
        SELECT user_id, event_id, {flag} AS flag,
               row_number() OVER w AS rn, CAST(sum({flag}) OVER w AS BIGINT) AS n
        FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)
    )
    SELECT true AS is_add, user_id, n AS cnt, event_id FROM c WHERE flag = 1 OR rn = 1
    UNION ALL
    SELECT false AS is_add, user_id, n - 1 AS cnt, event_id FROM c
    WHERE flag = 1 AND rn > 1"""

ORACLES = {
    "tumble_count_user_1h": """
        SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
               time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
               user_id, count(*) AS cnt
        FROM events GROUP BY ALL""",
    "tumble_multi_agg_5m": """
        SELECT time_bucket(INTERVAL '5 minutes', date_trunc('milliseconds', ts))
                 + INTERVAL '5 minutes' AS window_end,
               max(ts) AS max_ts, count(*) AS counter,
               CAST(max(CAST(value AS DECIMAL(10, 2))) AS DOUBLE) AS total_price
        FROM events GROUP BY 1""",
    "window_argmax_1h": """
        SELECT window_start, window_start + INTERVAL '1 hour' AS window_end,
               value, event_id, user_id
        FROM (SELECT *, time_bucket(INTERVAL '1 hour', ts) AS window_start FROM events)
        QUALIFY row_number() OVER (
            PARTITION BY window_start ORDER BY value DESC, event_id) = 1""",
    "window_argmax_user_1d": """
        SELECT epoch_ms(day) || '----' || epoch_ms(day + INTERVAL '1 day')
                 AS window_range,
               user_id, event_id, user_id || ':' || event_type AS record
        FROM (SELECT *, date_trunc('day', ts)::TIMESTAMP AS day FROM events)
        QUALIFY row_number() OVER (
            PARTITION BY day, user_id ORDER BY event_type DESC, event_id) = 1""",
    "edit_size_user_5s": """
        SELECT time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds'
                 AS window_end,
               user_id, CAST(sum(CAST(floor(value) AS BIGINT) - 50) AS BIGINT)
                 AS byte_diff
        FROM events GROUP BY ALL""",
    "edit_size_user_defined": """
        SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, user_id,
               CAST(sum(CAST(floor(value) AS BIGINT) - 50) AS BIGINT) AS diff
        FROM events GROUP BY ALL""",
    "props_by_row": """
        SELECT event_id, 'k' AS name,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS number
        FROM events""",
    "word_count": r"""
        SELECT word, count(*) AS frequency
        FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS word
              FROM documents)
        WHERE length(word) > 0 GROUP BY word""",
    "space_token_sum": """
        SELECT word, count(*) AS frequency
        FROM (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents
              WHERE NOT (length(text) > 0 AND length(rtrim(text, ' ')) = 0))
        GROUP BY word""",
    "grouped_sum": """
        SELECT l_returnflag, l_linestatus,
               CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) AS quantity
        FROM lineitem GROUP BY ALL""",
    "grouped_count": """
        SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type""",
    "group_sum_having": """
        SELECT user_id, count(*) AS frequency
        FROM events GROUP BY user_id HAVING count(*) = 60""",
    "filter_group_sum": """
        SELECT o_custkey,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS rev_sum
        FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey""",
    "union_all_filtered": """
        SELECT c_custkey AS id, c_name AS name, c_acctbal AS amount
        FROM customer WHERE c_acctbal > 5000
        UNION ALL
        SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal < 1000""",
    "derived_key_sum": """
        SELECT id, CAST(sum(l_linenumber) AS BIGINT) AS total
        FROM (SELECT l_orderkey // 2 AS id, l_linenumber FROM lineitem)
        WHERE id > 1 GROUP BY id""",
    "renamed_with_constant": """
        SELECT o_orderpriority AS word, 1 AS one, o_orderkey AS order_id FROM orders""",
    "non_blank_lines": r"""
        SELECT doc_id, count(*) AS lines
        FROM (SELECT doc_id, unnest(string_split(text, E'\n')) AS line FROM documents)
        WHERE regexp_matches(line, '[^\x09-\x0D\x1C-\x20\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}]')
        GROUP BY doc_id""",
    "parsed_lines": """
        SELECT CAST(user_id AS VARCHAR) AS user,
               TIMESTAMP '2020-12-16 00:00:00' + (date_trunc('second', ts)
                 - date_trunc('day', ts)) AS timestamp,
               '/' || event_type || '.html' AS url
        FROM events WHERE event_type <> 'error'""",
    "rejected_lines": f"""
        SELECT line FROM ({_CLICK_LINES}) WHERE event_type = 'error'""",
    "rendered_records": """
        SELECT CAST(event_id AS VARCHAR) AS id_text,
               user_id || '-' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '.'
                 || CASE WHEN rtrim(strftime(ts, '%f'), '0') = '' THEN '0'
                         ELSE rtrim(strftime(ts, '%f'), '0') END
                 || '-/' || event_type AS click,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS seconds,
               epoch_us(ts) // 1000 AS millis,
               date_trunc('milliseconds', ts) AS ts3
        FROM events""",
    "utc2local": """
        SELECT event_id, ts + INTERVAL '8 hours' AS local_ts FROM events""",
    "wall_clock_split": """
        SELECT event_id, ts,
               ts < TIMESTAMP '2024-01-16 00:00:00' - INTERVAL '5 days' AS late
        FROM events""",
    "count_window_2": """
        SELECT user_id, window_index, CAST(sum(score) AS BIGINT) AS total,
               CAST(CAST(sum(score) AS BIGINT) // count(*) AS DOUBLE) AS mean
        FROM (SELECT user_id, CAST(floor(value) AS BIGINT) AS score,
                     (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1)
                       // 2 AS window_index
              FROM events)
        GROUP BY user_id, window_index HAVING count(*) = 2""",
    "count_window_nulls": """
        SELECT user_id, window_index, CAST(sum(score) AS DOUBLE) AS total,
               CAST(CAST(sum(score) AS BIGINT) // count(score) AS DOUBLE) AS mean
        FROM (SELECT user_id,
                     CASE WHEN event_id % 3 <> 0 AND user_id % 5 <> 0
                          THEN CAST(floor(value) AS BIGINT) END AS score,
                     (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1)
                       // 2 AS window_index
              FROM events)
        GROUP BY user_id, window_index HAVING count(*) = 2""",
    "changelog_count_user": _CHANGES.format(flag="1"),
    "changelog_count_nulls": _CHANGES.format(
        flag="CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END"
    ),
    "pattern_signup_view_purchase_1d": f"""
        SELECT s.user_id, s.event_id AS signup_id, v.event_id AS view_id,
               p.event_id AS purchase_id
        {_FUNNEL} AND p.ts - s.ts <= INTERVAL '1 day'""",
    "pattern_match_text": f"""
        SELECT s.user_id,
               'signup=(' || s.event_id || '|signup);view=(' || v.event_id
                 || '|view);purchase=(' || p.event_id || '|purchase)' AS match
        {_FUNNEL} AND p.ts - s.ts <= INTERVAL '1 day'""",
    "pattern_match_count": f"""
        SELECT s.user_id, CAST(count(*) AS VARCHAR) AS matches
        {_FUNNEL} GROUP BY s.user_id""",
    "json_decoded": """
        SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
        FROM events""",
    "generated_counter": """
        SELECT CAST(event_id AS VARCHAR) AS value,
               make_timestamp(event_id * 2000) AS ts
        FROM events""",
    "generated_random": _RECORDS,
    "generated_random_argmax_1s": f"""
        SELECT window_start, window_start + INTERVAL '1 second' AS window_end,
               key, seq, boy
        FROM (SELECT *, date_trunc('second', ts) AS window_start FROM ({_RECORDS}))
        QUALIFY row_number() OVER (
            PARTITION BY window_start ORDER BY key DESC, seq) = 1""",
}
