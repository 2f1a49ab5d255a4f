"""Kafka topics.  The connector package must be on the cluster's class path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Six digits, so that timestamps survive the way through text.
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Client settings that Spark handles itself, with the option that replaces each.
_OFFSET_RESET = "auto.offset.reset"
_POLL_LIMIT = "max.poll.records"
_AUTO_COMMIT = "enable.auto.commit"
_DECODERS = ("key.deserializer", "value.deserializer")


def source_options(
    topic: str,
    client: Mapping[str, str],
    *,
    start: str = "earliest",
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka reader for a topic and a set of client settings.

    Offsets live in the query's checkpoint, so the client's commit and reset
    settings turn into ``startingOffsets``.  Its poll limit sizes a client's buffer and
    is dropped; ``max_offsets`` bounds a micro-batch.  So are decoders: values arrive
    as bytes.
    """
    options = {
        "subscribe": topic,
        "startingOffsets": str(client.get(_OFFSET_RESET, start)),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    handled = {_OFFSET_RESET, _POLL_LIMIT, _AUTO_COMMIT, *_DECODERS}
    for name, value in client.items():
        if name not in handled:
            options[f"kafka.{name}"] = str(value)
    return options


def stream_topic(
    spark: SparkSession,
    topic: str,
    client: Mapping[str, str],
    *,
    max_offsets: int | None = None,
) -> DataFrame:
    """A topic as a stream of key, value, topic, partition, offset and timestamp."""
    options = source_options(topic, client, max_offsets=max_offsets)
    return spark.readStream.format("kafka").options(**options).load()


def read_topic(
    spark: SparkSession, topic: str, client: Mapping[str, str]
) -> DataFrame:
    """What a topic holds now, as a table."""
    options = source_options(topic, client)
    return spark.read.format("kafka").options(**options).load()


def decode_text(envelope: DataFrame, out: str = "value") -> DataFrame:
    """The values as text."""
    return envelope.select(F.col("value").cast("string").alias(out))


def decode(
    envelope: DataFrame,
    schema: T.StructType,
    fmt: str = "json",
    *,
    event_time: str | None = None,
) -> DataFrame:
    """The values as columns of ``schema``, read as ``json`` or ``csv``.

    ``event_time`` names a column for the record's own timestamp.  A value that does
    not parse gives a row of nulls; :func:`rejected` returns it.
    """
    record = _record(schema, fmt).alias("_record")
    times = [] if event_time is None else [F.col("timestamp").alias(event_time)]
    return envelope.select(record, *times).select(
        "_record.*", *([] if event_time is None else [event_time])
    )


_REJECT = "_corrupt_record"


def _record(schema: T.StructType, fmt: str) -> Column:
    text = F.col("value").cast("string")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parsers = {
        "json": lambda: F.from_json(text, schema, TIME_FORMATS),
        "csv": lambda: F.from_csv(text, ddl, TIME_FORMATS),
    }
    return parsers[fmt]()


def rejected(envelope: DataFrame, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """The records whose value does not parse as ``schema``, as they came."""
    watched = T.StructType([*schema.fields, T.StructField(_REJECT, T.StringType())])
    options = {**TIME_FORMATS, "columnNameOfCorruptRecord": _REJECT}
    text = F.col("value").cast("string")
    if fmt == "json":
        record = F.from_json(text, watched, options)
    else:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in watched)
        record = F.from_csv(text, ddl, options)
    bad = text.isNull() | record.isNull() | record[_REJECT].isNotNull()
    return envelope.where(bad)


def counted(decoded: DataFrame, observation: Observation | str) -> DataFrame:
    """The same rows, counted on the way as the metric ``records``."""
    return decoded.observe(observation, F.count(F.lit(1)).alias("records"))


def register_topic_view(
    envelope: DataFrame, name: str, schema: T.StructType, fmt: str = "json"
) -> DataFrame:
    """Makes a topic's decoded rows a view for SQL; an append-only table."""
    decoded = decode(envelope, schema, fmt)
    decoded.createOrReplaceTempView(name)
    return decoded
