"""Queries that write a table through a sink and return what the source reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import parse, relational
from millrace.plans import tables
from millrace.plans.streams import events_stream
from millrace.session import is_local, scratch_path
from millrace.sinks import catalog as catalog_sink
from millrace.sinks import files as file_sink
from millrace.sinks import jdbc as jdbc_sink
from millrace.sinks import kafka as kafka_sink
from millrace.sources import catalog, files, jdbc, kafka, splitcsv
from millrace.streaming.run import appended

JDBC_URL = "spark.millrace.jdbc.url"

EVENT_COLUMNS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("value", T.DecimalType(10, 2)),
        T.StructField("event_type", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("props", T.StringType()),
    ]
)

# A control character that no text of the tables has.
NULL_TEXT = "\x01"

ORDER_COLUMNS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderstatus", T.StringType()),
    ]
)


def _cast(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(field.name).cast(field.dataType) for field in schema])


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    file_sink.write_csv(_cast(tables.table(spark, sf_dir, "events"), EVENT_COLUMNS), path)
    read = files.read_csv(spark, path, EVENT_COLUMNS)
    return read.withColumn("value", F.col("value").cast("double"))


def _texts_written(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    """Files of texts with line breaks, quotes, outer blanks, empty ones and nulls."""
    path = scratch_path(spark, "csv-texts")
    texts = tables.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 5 == 0, F.lit(""))
        .when(F.col("doc_id") % 5 == 1, F.lit(None))
        .when(F.col("doc_id") % 5 == 2, F.concat(F.lit(' "'), "text", F.lit("\\,  ")))
        .otherwise(F.col("text"))
        .alias("text"),
    )
    file_sink.write_csv(texts, path, null_text=NULL_TEXT)
    return path, texts.schema


def csv_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read file by file."""
    path, schema = _texts_written(spark, sf_dir)
    return files.read_csv(spark, path, schema, null_text=NULL_TEXT, multi_line=True)


def csv_texts_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read in chunks of files, whatever quoted line breaks they hold."""
    path, schema = _texts_written(spark, sf_dir)
    return splitcsv.read_split_csv(spark, path, schema, null_text=NULL_TEXT)


def stream_csv_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read as a stream."""
    path, schema = _texts_written(spark, sf_dir)
    texts = files.stream_csv(spark, path, schema, null_text=NULL_TEXT, multi_line=True)
    return appended(texts, "csv-texts-read")


def tab_csv_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "tab")
    words = tables.table(spark, sf_dir, "orders").select("o_orderpriority")
    file_sink.write_csv(words, f"{base}/words")
    read = files.read_csv(
        spark, f"{base}/words", T.StructType.fromDDL("word string")
    )
    counts = relational.grouped_count(read, ["word"], "cnt")
    file_sink.write_csv(counts, f"{base}/counts", delimiter="\t", overwrite=True)
    return files.read_csv(
        spark,
        f"{base}/counts",
        T.StructType.fromDDL("word string, cnt bigint"),
        delimiter="\t",
    )


def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "text")
    events = tables.table(spark, sf_dir, "events")
    line = F.concat_ws(
        " ",
        F.col("user_id").cast("string"),
        F.date_format("ts", "HH:mm:ss"),
        F.concat(F.lit("/"), "event_type"),
    )
    file_sink.write_text(events, path, line, overwrite=True)
    clicks = parse.parse_click_lines(files.read_text(spark, path), "2020-12-16")
    return clicks.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved with the last column as partition, then read by name."""
    events = tables.table(spark, sf_dir, "events")
    name = f"events_{uuid.uuid4().hex}"
    catalog.save_table(
        events.select("event_id", "user_id", "event_type"),
        name,
        partition_columns=1,
        location=scratch_path(spark, "table"),
    )
    return catalog.read_table(spark, name)


def table_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created by DDL, filled by position with differently named columns."""
    name = f"devices_{uuid.uuid4().hex}"
    catalog.create_table(
        spark,
        name,
        T.StructType.fromDDL("id bigint, name string"),
        "csv",
        location=scratch_path(spark, "insert"),
    )
    customers = tables.table(spark, sf_dir, "customer")
    catalog_sink.insert_into(customers.select("c_custkey", "c_name"), name)
    return catalog.read_table(spark, name)


def _envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a topic would hold them."""
    events = tables.table(spark, sf_dir, "events")
    records = kafka_sink.encode_json(events, ["event_id", "event_type"])
    return records.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
    )


def kafka_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kafka.decode(
        _envelope(spark, sf_dir),
        T.StructType.fromDDL(
            "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
            "value double, props string"
        ),
    )


def kafka_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per key, where parts of keys are null or hold what joins them in text."""
    events = tables.table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 3 == 0, None).otherwise(F.lit("a|b")).alias("k"),
        F.when(F.col("user_id") % 2 == 0, None).otherwise(F.lit("a")).alias("m"),
    )
    records = kafka_sink.encode_json(events, ["k", "m"])
    parts = F.from_json("key", "k string, m string")
    return records.groupBy("key").agg(F.count("*").alias("cnt")).select(
        parts["k"].alias("k"), parts["m"].alias("m"), "cnt"
    )


def kafka_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of errors are broken on purpose and come back as rejects."""
    events = tables.table(spark, sf_dir, "events")
    envelope = events.select(
        F.when(F.col("event_type") == "error", F.concat(F.lit("{"), "event_id"))
        .otherwise(F.to_json(F.struct("event_id", "user_id")))
        .cast("binary")
        .alias("value")
    )
    bad = kafka.rejected(envelope, T.StructType.fromDDL("event_id bigint, user_id bigint"))
    return kafka.decode_text(bad, "text")


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose amount is no number are returned as they were written."""
    path = scratch_path(spark, "csv-rejects")
    orders = tables.table(spark, sf_dir, "orders")
    amount = F.when(F.col("o_orderstatus") == "F", F.lit("none")).otherwise(F.lit("12.5"))
    file_sink.write_text(orders, path, F.concat_ws(",", "o_orderkey", amount))
    schema = T.StructType.fromDDL("o_orderkey bigint, amount double")
    return files.rejected_csv(spark, path, schema)


def kafka_sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"topic_{uuid.uuid4().hex}"
    kafka.register_topic_view(
        _envelope(spark, sf_dir),
        name,
        T.StructType.fromDDL("event_id bigint, event_type string"),
    )
    return spark.sql(
        f"SELECT event_type, sum(event_id) AS total FROM {name} GROUP BY event_type"
    )


def jdbc_options(spark: SparkSession) -> dict[str, str]:
    """The database named by the session, or in local mode one inside this process.

    On a cluster the executors could not see such a database, so there the setting
    is required.
    """
    url = spark.conf.get(JDBC_URL, None)
    if url:
        return {"url": url}
    if not is_local(spark):
        raise RuntimeError(f"{JDBC_URL} must name a database the executors can reach")
    return {"url": f"jdbc:derby:memory:d{uuid.uuid4().hex};create=true"}


def jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = jdbc_options(spark)
    name = f"orders_{uuid.uuid4().hex}"
    orders = _cast(tables.table(spark, sf_dir, "orders"), ORDER_COLUMNS)
    jdbc_sink.append(
        orders, options, name, column_types="o_orderstatus VARCHAR(8)"
    )
    first, last = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return jdbc.read_table(
        spark,
        options,
        name,
        orders.schema,
        column="o_orderkey",
        lower=first,
        upper=last,
        partitions=4,
    )


def jdbc_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = jdbc_options(spark)
    name = f"counts_{uuid.uuid4().hex}"
    empty = spark.createDataFrame([], "user_id bigint, cnt bigint")
    jdbc_sink.append(empty, options, name)
    counts = relational.grouped_count(
        events_stream(spark, sf_dir), ["user_id"], "cnt", "event_type"
    )
    jdbc_sink.stream_upsert(
        counts, options, name, ["user_id"], scratch_path(spark, "upsert")
    ).awaitTermination()
    return jdbc.read_query(
        spark,
        options,
        f'SELECT "user_id", "cnt" FROM {name} WHERE "cnt" > 0',
        empty.schema,
    )


QUERIES = {
    function.__name__: function
    for function in (
        csv_roundtrip,
        csv_texts,
        csv_texts_split,
        stream_csv_texts,
        csv_rejects,
        kafka_keys,
        kafka_rejects,
        tab_csv_group_count,
        text_roundtrip,
        table_roundtrip,
        table_insert,
        kafka_envelope,
        kafka_sql_view,
    )
}

_TEXTS = r"""
        SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL
                 WHEN 2 THEN ' "' || text || '\,  ' ELSE text END AS text
        FROM documents"""

ORACLES = {
    "csv_texts": _TEXTS,
    "csv_texts_split": _TEXTS,
    "stream_csv_texts": _TEXTS,
    "csv_rejects": """
        SELECT o_orderkey || ',none' AS line FROM orders WHERE o_orderstatus = 'F'""",
    "kafka_keys": """
        SELECT CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'a|b' END AS k,
               CASE WHEN user_id % 2 = 0 THEN NULL ELSE 'a' END AS m, count(*) AS cnt
        FROM events GROUP BY 1, 2""",
    "kafka_rejects": """
        SELECT '{' || event_id AS text FROM events WHERE event_type = 'error'""",
    "csv_roundtrip": """
        SELECT event_id, CAST(CAST(value AS DECIMAL(10, 2)) AS DOUBLE) AS value,
               event_type, ts, props
        FROM events""",
    "tab_csv_group_count": """
        SELECT o_orderpriority AS word, count(*) AS cnt
        FROM orders GROUP BY o_orderpriority""",
    "text_roundtrip": """
        SELECT CAST(user_id AS VARCHAR) AS user,
               TIMESTAMP '2020-12-16 00:00:00' + (date_trunc('second', ts)
                 - date_trunc('day', ts)) AS timestamp,
               '/' || event_type AS url
        FROM events""",
    "table_roundtrip": "SELECT event_id, user_id, event_type FROM events",
    "table_insert": "SELECT c_custkey AS id, c_name AS name FROM customer",
    "kafka_envelope": """
        SELECT event_id, ts, user_id, event_type, value, props FROM events""",
    "kafka_sql_view": """
        SELECT event_type, CAST(sum(event_id) AS BIGINT) AS total
        FROM events GROUP BY event_type""",
}
