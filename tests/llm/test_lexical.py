"""Ranked search against scores counted one by one."""

import math
import re
from collections import Counter

import pytest

from millrace.llm import lexical
from tests.llm import odd

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def listed(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, best=10):
    bags = [(name, Counter(listed(text))) for name, text in docs]
    n_docs, n_words = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    terms = {}
    for name, text in items:
        terms.setdefault(name, set()).update(listed(text))
    rows = []
    for name, some in terms.items():
        scored = []
        for doc, bag in bags:
            if not bag:
                continue
            m = 100 - 90 + (90 * bag.total() * n_docs) // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in some
                if t in bag
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda s: s[:3])
        rows += [(name, k + 1, s[3], -s[0]) for k, s in enumerate(scored[:best])]
    return sorted(rows, key=str)


ITEMS = [
    ("a", odd.prose(1, 30)),
    ("a", "one two"),  # one item with the one above
    ("b", odd.prose(2, 20).upper()),
    ("c", None),
    ("d", ""),
    ("e", "no-such-term"),
    (None, "one"),
    ("f", "über ÜBER né 12345"),
    ("f", "über ÜBER né 12345"),
]


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(a, b, 1) for a, b in rows], "item_id string, text string, score int")


def answer(found):
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("block", [1_000_000, 10])
def test_equals_plain_search(spark, block):
    docs = odd.documents(spark).repartition(5)
    found = lexical.best_documents(docs, items(spark), block_postings=block)
    assert answer(found) == plain([(r[0], r[1]) for r in odd.rows()], ITEMS)


def test_many_ties_and_small_steps(spark, monkeypatch):
    monkeypatch.setattr(lexical, "CELLS", 8)
    texts = [(k, "x y" if k % 3 else "x y z") for k in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    rows = [("a", "x"), ("b", "z q"), ("c", "y z")]
    assert answer(lexical.best_documents(docs, items(spark, rows), best=4)) == plain(texts, rows, 4)


def test_sums_above_doubles_stay_whole():
    index = lexical._index([("a", b"x"), ("a", b"y"), ("b", b"y")])
    weight = lexical.np.array([7, 11], dtype="int64")
    lists, sizes = [{0: 3, 1: 1}, {1: 2}], [40, 90]
    assert (
        lexical._scores(index, weight, lists, sizes, True) == lexical._scores(index, weight, lists, sizes, False)
    ).all()


def test_string_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("p", "x"), ("o", "x"), (None, "x"), ("q", "r")], "doc_id string, text string")
    found = lexical.best_documents(docs, items(spark, [("a", "x")]))
    assert [r.doc_id for r in found.orderBy("rank").collect()] == ["o", "p", None]
    assert lexical.best_documents(docs.limit(0), items(spark)).collect() == []
    assert lexical.best_documents(docs, items(spark).limit(0)).collect() == []
