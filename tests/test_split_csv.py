"""CSV files with quoted line breaks in several tasks."""

import random

import pytest
from pyspark.sql import types as T

from millrace.sinks.files import write_csv
from millrace.sources import files, splitcsv
from tests.fixtures import tuples

SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("rest", T.StringType())]
)


def texts(count):
    pick = random.Random(7)
    for n in range(count):
        kind = pick.randrange(8)
        text = {
            0: None,
            1: "",
            2: 'say "x"\nand\n\n"y"',
            3: " outer ",
            4: "a,b\n" * pick.randrange(60),
            5: '"',
            6: "\n",
        }.get(kind, f"plain {n}")
        yield n, text, "end, é" if n % 2 else None


@pytest.fixture
def one_file(spark, tmp_path):
    rows = list(texts(3_000))
    path = str(tmp_path / "out")
    write_csv(spark.createDataFrame(rows, SCHEMA), path, single_file=True, null_text=r"\N")
    return path, sorted(rows, key=repr)


@pytest.mark.parametrize("chunk", ["1g", "64k", "2k", "100"])
def test_chunks_of_any_size_give_the_same_rows(spark, one_file, chunk):
    path, rows = one_file
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name in names:
            spark.conf.set(name, chunk)
        found = splitcsv.read_split_csv(spark, path, SCHEMA, null_text=r"\N")
        records = splitcsv.csv_records(spark, path)
        if chunk == "2k":
            assert spark.read.text(path).rdd.getNumPartitions() > 20
        assert tuples(found) == rows
        assert records.where("is_first").count() == 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    whole = files.read_csv(spark, path, SCHEMA, null_text=r"\N", multi_line=True)
    assert tuples(whole) == rows


def test_header_blank_lines_and_carriage_returns(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'id,text,rest\r\n1,"a\nb",c\r\n\r\n2,,"x ""y"""\r\n')
    (tmp_path / "b.csv").write_bytes(b'id,"te\nxt",rest\n3,z,')
    (tmp_path / "c.csv").write_bytes(b"")
    found = splitcsv.read_split_csv(spark, str(tmp_path), SCHEMA, header=True)
    assert tuples(found) == [(1, "a\nb", "c"), (2, None, 'x "y"'), (3, "z", None)]


def test_a_quote_that_nothing_closes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,a,b\n2,"open\nto the end')
    records = splitcsv.csv_records(spark, str(tmp_path)).select("record")
    assert tuples(records) == [("1,a,b",), ('2,"open\nto the end',)]


def test_too_many_chunks(spark, one_file, monkeypatch):
    monkeypatch.setattr(splitcsv, "BROADCAST_CHUNKS", 0)
    with pytest.raises(ValueError, match="chunks"):
        splitcsv.csv_records(spark, one_file[0])


def test_the_stream_reads_what_was_written(spark, one_file, tmp_path):
    path, rows = one_file
    stream = files.stream_csv(spark, path, SCHEMA, null_text=r"\N", multi_line=True)
    query = (
        stream.writeStream.format("parquet").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "cp")).start(str(tmp_path / "rows"))
    )
    query.awaitTermination()
    assert tuples(spark.read.parquet(str(tmp_path / "rows")).select(*SCHEMA.names)) == rows
