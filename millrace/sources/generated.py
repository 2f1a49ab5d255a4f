"""Rows from the program itself: literals, sequences and seeded random records."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import char_at

# Names, row counts and time steps of the generated records.
BOYS = ("boy-A", "boy-B", "boy-C", "boy-D", "boy-E")
COUNTER_ROWS = 1001
RECORD_ROWS = 1002
COUNTER_STEP_MS = 2
RECORD_STEP_MS = 5
FIRST_KEY = ord("A")
KEYS = 26

# The multiplier and modulus of a well-known congruential generator.
_MULTIPLIER = 48271
_MODULUS = 2147483647


def rows(
    spark: SparkSession,
    data: Iterable[tuple],
    schema: T.StructType,
    *,
    seq: str | None = None,
) -> DataFrame:
    """A small frame from literal rows; ``seq`` names a column for their position."""
    listed = list(data)
    if seq is None:
        return spark.createDataFrame(listed, schema)
    numbered = T.StructType([T.StructField(seq, T.IntegerType()), *schema.fields])
    return spark.createDataFrame(
        [(position, *row) for position, row in enumerate(listed)], numbered
    )


def sequences(
    spark: SparkSession, fields: Mapping[str, tuple[int, int, str]]
) -> DataFrame:
    """Columns counting in step from start to end, both included.

    ``fields`` gives ``(start, end, type)`` by name.  The rows end with the shortest
    sequence.
    """
    length = min(end - start + 1 for start, end, _ in fields.values())
    base = spark.range(max(0, length))
    return base.select(
        *[
            (F.col("id") + start).cast(kind).alias(name)
            for name, (start, _, kind) in fields.items()
        ]
    )


def with_counter(ids: DataFrame, id_column: str = "id") -> DataFrame:
    """``value`` as text and ``ts``, two milliseconds apart, for each id."""
    number = F.col(id_column)
    return ids.select(
        number.cast("string").alias("value"),
        F.timestamp_millis(number * COUNTER_STEP_MS).alias("ts"),
    )


def counter(spark: SparkSession, length: int = COUNTER_ROWS) -> DataFrame:
    return with_counter(spark.range(length))


def _picked(number: Column, seed: int, choices: int) -> Column:
    """A whole number below ``choices``, fixed by the id and the seed."""
    state = F.pmod(number + seed, F.lit(_MODULUS))
    for _ in range(2):
        state = F.pmod(state * _MULTIPLIER + 1, F.lit(_MODULUS))
    return F.pmod(state, F.lit(choices))


def with_random_record(
    ids: DataFrame, id_column: str = "id", *, seed: int = 0
) -> DataFrame:
    """A boy, a key ``A``..``Z`` and a time five milliseconds apart, for each id."""
    number = F.col(id_column).cast("bigint")
    boys = F.array(*[F.lit(boy) for boy in BOYS])
    boy = _picked(number, seed, len(BOYS))
    key = _picked(number, seed + 1_000_003, KEYS)
    return ids.select(
        F.element_at(boys, (boy + 1).cast("int")).alias("boy"),
        char_at(key + FIRST_KEY).alias("key"),
        F.timestamp_millis(number * RECORD_STEP_MS).alias("ts"),
        number.alias("seq"),
    )


def random_records(
    spark: SparkSession, length: int = RECORD_ROWS, *, seed: int = 0
) -> DataFrame:
    return with_random_record(spark.range(length), seed=seed)


def stream_ids(
    spark: SparkSession, rows_per_batch: int, *, start_millis: int = 0
) -> DataFrame:
    """An unbounded stream of ids 0, 1, 2, ... to feed the generators above."""
    stream = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("startTimestamp", start_millis)
        .load()
    )
    return stream.select(F.col("value").alias("id"))


def values(spark: SparkSession, text: str, names: Sequence[str]) -> DataFrame:
    """Rows written as SQL literals, such as ``(1, 'a'), (2, 'b')``."""
    return spark.sql(f"SELECT * FROM VALUES {text} AS t({', '.join(names)})")
