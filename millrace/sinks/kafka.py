"""Writing to Kafka.

Spark's Kafka sink delivers every record at least once and has no transactions.
For results that count once, give each record a stable key and drop repeats at the
reader with :func:`once_per_key`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.kafka import TIME_FORMATS
from millrace.streaming.run import start


def encode_text(df: DataFrame, text: Column) -> DataFrame:
    """Records whose value is a text."""
    return df.select(text.cast("string").alias("value"))


def encode_json(df: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """Records whose value is the row as JSON, nulls included, keyed by ``key`` columns.

    The key is JSON, too: different keys, nulls among them, give different texts.
    """
    options = {"ignoreNullFields": "false", **TIME_FORMATS}
    value = F.to_json(F.struct("*"), options).alias("value")
    if not key:
        return df.select(value)
    return df.select(F.to_json(F.struct(*key), options).alias("key"), value)


def write_topic(records: DataFrame, topic: str, client: Mapping[str, str]) -> None:
    records.write.format("kafka").options(**sink_options(topic, client)).save()


def stream_to_topic(
    records: DataFrame,
    topic: str,
    client: Mapping[str, str],
    checkpoint: str,
    *,
    interval: str | None = None,
) -> StreamingQuery:
    writer = records.writeStream.format("kafka").options(**sink_options(topic, client))
    return start(writer, records.sparkSession, checkpoint, interval=interval)


def sink_options(topic: str, client: Mapping[str, str]) -> dict[str, str]:
    serializers = {"key.serializer", "value.serializer"}
    options = {"topic": topic}
    for name, value in client.items():
        if name not in serializers:
            options[f"kafka.{name}"] = str(value)
    return options


def once_per_key(df: DataFrame, ts: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """Drops repeats of a key that arrive within ``delay`` of the first."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
