"""CSV files with quoted line breaks, read in many tasks.

Whether a line break ends a record depends on how many quotes stand before it in the file.
Those are counted per chunk first; their sums over the earlier chunks say in which state each
chunk begins.  Then every chunk is cut into records by itself.  What a chunk holds of a
record that began before it, or that ends after it, is put together from such
pieces, at most two for each chunk.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.files import csv_options

# What runs in tasks travels with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WHOLE, HEAD, TAIL = 0, 1, 2  # a record, the end of one, the begin of one
_CHUNK = ("_file", "_block")
# Chunks are as large as the scan's splits: this many are 100 TB at 128 MB.
BROADCAST_CHUNKS = 1_000_000
BATCH_RECORDS = 10_000
BATCH_CHARS = 16 << 20

RECORDS = T.StructType(
    [
        T.StructField("_file", T.StringType()),
        T.StructField("_block", T.LongType()),
        T.StructField("_kind", T.IntegerType()),
        T.StructField("_first", T.BooleanType()),
        T.StructField("record", T.StringType()),
    ]
)


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces of records of each chunk; a chunk's lines come one after the other."""
    rows: list[tuple] = []
    chars = 0

    def sent() -> pa.RecordBatch:
        columns = zip(*rows) if rows else ([] for _ in RECORDS)
        types = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types)], RECORDS.names
        )

    chunk, kind, lines, is_open, is_first = None, WHOLE, [], False, False
    for batch in batches:
        for value, name, block, odd, quotes in zip(*[batch[k].to_pylist() for k in range(5)]):
            if (name, block) != chunk:
                if lines:  # the last chunk's open record
                    rows.append((*chunk, HEAD if kind == HEAD else TAIL, is_first, "\n".join(lines)))
                chunk, lines, is_open, is_first = (name, block), [], bool(odd), block == 0
                kind = HEAD if is_open else WHOLE
            lines.append(value)
            is_open ^= bool(quotes % 2)
            if not is_open:
                rows.append((*chunk, kind, is_first, "\n".join(lines)))
                chars += len(rows[-1][-1])
                kind, lines, is_first = WHOLE, [], False
                if len(rows) >= BATCH_RECORDS or chars >= BATCH_CHARS:
                    yield sent()
                    rows, chars = [], 0
    if lines:
        rows.append((*chunk, HEAD if kind == HEAD else TAIL, is_first, "\n".join(lines)))
    yield sent()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``record, is_first`` for each record of the files, as it stands there.

    Quotes are doubled inside quoted values and stand nowhere in others, as ``write_csv``
    leaves them.  ``is_first`` marks the first record of a file.  Records end with a line
    feed, before which a carriage return is dropped.  A record that no quote
    closes is what is left of its file.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
        )
        .withColumn("_quotes", _quotes(F.col("value")))
    )
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        lines.groupBy(*_CHUNK)
        .agg(F.sum("_quotes").alias("_sum"))
        .select(*_CHUNK, (F.coalesce(F.sum("_sum").over(before), F.lit(0)) % 2).alias("_odd"))
        .persist()
    )
    n_chunks = chunks.count()
    if n_chunks > BROADCAST_CHUNKS:
        raise ValueError(
            f"{n_chunks} chunks: raise spark.sql.files.maxPartitionBytes or read fewer files at a time"
        )
    # The join keeps each task's lines in their order: only the chunks' table moves.
    marked = lines.join(F.broadcast(chunks), list(_CHUNK)).select("value", *_CHUNK, "_odd", "_quotes")
    found = marked.mapInArrow(_records, RECORDS)
    # A record over several chunks: its tail, then heads up to the one that closes it.
    pieces = found.where(F.col("_kind") != WHOLE)
    upto = Window.partitionBy("_file").orderBy("_block", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    over = (
        pieces.withColumn("_number", F.sum((F.col("_kind") == TAIL).cast("int")).over(upto))
        .groupBy("_file", "_number")
        .agg(F.array_sort(F.collect_list(F.struct("_block", "_kind", "record", "_first"))).alias("_parts"))
        .select(
            F.array_join(F.transform("_parts", lambda part: part["record"]), "\n").alias("record"),
            F.exists("_parts", lambda part: part["_first"]).alias("is_first"),
        )
    )
    whole = found.where(F.col("_kind") == WHOLE).select("record", F.col("_first").alias("is_first"))
    return whole.unionByName(over).withColumn("record", F.regexp_replace("record", r"\r\z", ""))


def read_split_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    delimiter: str = ",",
    header: bool = False,
    null_text: str = "",
) -> DataFrame:
    """``read_csv`` of files whose quoted values hold line breaks, each in many tasks."""
    records = csv_records(spark, path).where("record <> ''")
    if header:
        records = records.where(~F.col("is_first"))
    options = {name: str(value) for name, value in csv_options(delimiter, null_text).items()}
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    return records.select(F.from_csv("record", ddl, options).alias("row")).select("row.*")
