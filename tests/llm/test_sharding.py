"""Shards: sizes, slots and links, whatever the groups."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as contract
from millrace.llm import sharding
from tests.llm import odd


def checked(docs, found, shards):
    """The law, the slots and each row's own columns; returns shards by text."""
    def plain(doc_id, text):
        data = (text or "").encode()
        return doc_id, len(data) + 1, zlib.crc32(data)

    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(plain(*d) for d in docs)
    slots = defaultdict(list)
    for row in found:
        assert row.law == "rows" and row.grown_shard is None
        slots[row.shard].append(row.slot)
    sizes = [len(slots.get(k, [])) for k in range(shards)]
    assert set(slots) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_text = defaultdict(Counter)
    for row in found:
        by_text[(row.size, row.text_crc32)][row.shard] += 1
    return by_text


def frame(spark, docs, partitions=3):
    rows = [(a, b, 1, 2) for a, b in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, n int, shard int").repartition(partitions)


def test_odd_table(spark):
    docs = [(r[0], r[1]) for r in odd.rows()]
    found = sharding.balanced_shards(odd.documents(spark)).collect()
    checked(docs, found, 16)


def test_groups_that_fit_stay_whole(spark):
    pick = random.Random(3)
    docs = [(k, f"alone {k}") for k in range(300)]
    docs += [(1000 + k, f"pair {k // 2}") for k in range(200)]
    docs += [(2000 + k, f"few {k // 7}") for k in range(70)]
    pick.shuffle(docs)
    found = sharding.balanced_shards(frame(spark, docs), 8).collect()
    by_text = checked(docs, found, 8)
    assert all(len(c) == 1 for c in by_text.values())


def test_pairs_without_any_room(spark):
    docs = [(k, f"pair {k // 2}") for k in range(400)]
    by_text = checked(docs, sharding.balanced_shards(frame(spark, docs), 4).collect(), 4)
    assert sum(len(c) > 1 for c in by_text.values()) <= 4


def test_a_group_above_a_shard_fills_as_few_as_it_can(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 50)  # the group is ranked in pieces
    monkeypatch.setattr(sharding, "PIECE", 3)
    docs = [(k, "copy") for k in range(300)] + [(None, "copy")] * 40 + [(1000 + k, f"t {k}") for k in range(660)]
    docs += [(3000 + k, f"pair {k // 2}") for k in range(60)]
    found = sharding.balanced_shards(frame(spark, docs), 10).collect()
    by_text = checked(docs, found, 10)
    copies = by_text[(5, zlib.crc32(b"copy"))]
    assert len(copies) == 4  # 340 rows, shards of 106
    assert sum(len(c) > 1 for c in by_text.values()) <= 2


def test_places_do_not_depend_on_partitions(spark):
    docs = [(r[0], r[1]) for r in odd.rows()] * 3
    one, two = (
        Counter(map(tuple, sharding.balanced_shards(frame(spark, docs, p), 5).collect())) for p in (1, 6)
    )
    assert one == two


@pytest.mark.parametrize("docs", [[], [(1, "a")], [(None, None)] * 5, [(1, ""), (2, None)]])
def test_tiny_tables(spark, docs):
    found = sharding.balanced_shards(frame(spark, docs), 16).collect()
    if docs:
        checked(docs, found, 16)
    else:
        assert found == []


def test_query(spark):
    at = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{at}/documents.parquet").collect()]
    by_text = checked(docs, contract.queries()["op12_shards"](spark, at).collect(), 16)
    assert all(len(c) == 1 for c in by_text.values() if c.total() <= len(docs) // 32)


def test_no_python_on_the_main_path(spark):
    plan = sharding.balanced_shards(frame(spark, [(1, "a"), (2, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
