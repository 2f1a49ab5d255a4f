"""The registered queries on the smallest tables: against their SQL, or brute force."""

from __future__ import annotations

import os
import zlib

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from millrace.llm.licenses import BASE_PHRASES
from tests.oracle import canonical, connect, kinds

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_all_operators_and_the_pipeline_are_registered():
    names = contract.queries()
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(contract.LLM_SQL))
def test_query_equals_sql(spark, name):
    found = contract.queries()[name](spark, SF_DIR).toPandas()
    with connect(SF_DIR) as duck:
        expected = duck.execute(contract.LLM_SQL[name]).df()
    assert kinds(found) == kinds(expected)
    assert canonical(found) == canonical(expected)


def test_base_phrases(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    found = {r.doc_id: r for r in contract.queries()["op8_licenses"](spark, SF_DIR).collect()}
    assert len(found) == len(rows)
    for row in rows:
        low = (row.text or "").encode().lower().decode()
        words = "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in low).split()
        starts = [
            (k, label)
            for label, phrase in BASE_PHRASES.items()
            for k in range(len(words))
            if words[k : k + len(phrase.split())] == phrase.split()
        ]
        got = found[row.doc_id]
        assert (got.n_words, got.n_base) == (len(words), len(starts))
        assert got.first_word == min((k for k, _ in starts), default=None)
        assert got.last_word == max((k for k, _ in starts), default=None)
        assert got.base_labels == ",".join(sorted({label for _, label in starts}))


def test_languages_held_out(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = contract.queries()["op5_language"](spark, SF_DIR).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    text_of = {r.doc_id: r.text for r in docs.collect()}
    mixed = corpus_pipeline.run(spark, SF_DIR).collect()
    kept = [r.doc_id for r in mixed]
    assert 0 < len(kept) == len(set(kept)) and set(kept) <= set(text_of)
    assert len({text_of[k] for k in kept}) == len(kept)
    size: dict = {}
    for row in mixed:
        size[row.source] = size.get(row.source, 0) + row.size
        assert row.taken <= 3 * row.size
    assert all(r.source_size == size[r.source] for r in mixed)
