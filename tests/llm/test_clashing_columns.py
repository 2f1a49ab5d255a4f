"""Stages keep every value of the caller's columns, whatever their names."""

from collections import Counter

import pytest

from millrace.llm import decontaminate, jaccard, ordinal, suffix
from tests.llm import odd

NAMES = "_tail _expected _text_key text_key spans id_hash text_hash found component node n first stays copies".split()


def wide(spark):
    """Every row has its own values, the same in all the extra columns."""
    rows = [(r[0], r[1], *[f"{name} {k}" for name in NAMES], k) for k, r in enumerate(odd.rows())]
    schema = "doc_id long, text string, " + ", ".join(f"{name} string" for name in NAMES) + ", place long"
    return spark.createDataFrame(rows, schema), {r[-1]: r for r in rows}


def stages(spark):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(5, 20)], "doc_id long, quality long, toxic long")
    items = spark.createDataFrame([("a", odd.prose(2, 70)), ("b", odd.prose(4, 60))], "item_id string, text string")
    return {
        "quality": lambda docs: ordinal.keep_good(docs, labels, 0.0),
        "near": lambda docs: jaccard.one_of_each(docs, 5, 80),
        "passages": lambda docs: suffix.without_repeats(docs),
        "benchmark": lambda docs: decontaminate.decontaminate(docs, items),
    }


@pytest.mark.parametrize("name", ["quality", "near", "passages", "benchmark"])
def test_values_stay(spark, name):
    docs, rows = wide(spark)
    kept = stages(spark)[name](docs)
    assert kept.columns == docs.columns
    found = [tuple(row) for row in kept.collect()]
    assert found and len({row[-1] for row in found}) == len(found)
    for row in found:
        source = rows[row[-1]]
        assert row[0] == source[0] and row[2:] == source[2:]
        if name != "passages":
            assert row[1] == source[1]
    if name == "quality":
        assert Counter(found) == Counter(rows.values())


def test_stages_one_after_the_other(spark):
    docs, rows = wide(spark)
    for stage in stages(spark).values():
        docs = stage(docs).cache()
    found = docs.collect()
    assert found and all(tuple(row)[2:] == rows[row[-1]][2:] for row in found)
