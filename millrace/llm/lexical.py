"""Ranked lexical search turned round: the items are the index, documents stream through it.

Built for a stated set of items and any number of documents.  The inverted index over the
items' terms is broadcast in blocks of bounded size; each task keeps, for each item, a heap
of the best documents it has seen; the heaps are merged by a window.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.text import cut_lineage

BEST = 10
# (item, term) pairs in one broadcast index: below 100 MB with terms of usual length.
# More items are taken in blocks, with one pass over the documents each.
BLOCK_POSTINGS = 1_000_000
CELLS = 1 << 20  # scores of (document, item) held at a time
STEPS = 1 << 21  # postings expanded at a time, a single document's apart

# ASCII letters in lower case, digits and all bytes of other characters; the rest separates.
_SIGNS = bytes(
    sign + 32 if 65 <= sign <= 90 else sign if sign >= 128 or chr(sign).isalnum() else 32 for sign in range(256)
)


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_SIGNS).split()


@dataclass
class Index:
    """Inverted index of a block of items: term ``t`` stands in ``items[start[t]:start[t + 1]]``."""

    names: list
    numbers: dict[bytes, int]
    start: np.ndarray
    items: np.ndarray


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(len(batch)):
            found = sorted(set(terms(batch["text"][k].as_py())))
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(batch["item_id"][k], len(found)), pa.array(found, pa.binary())], ["item_id", "term"]
            )


def _index(rows: list) -> Index:
    """Of ``item_id, term`` rows, each once."""
    names, numbers = {}, {}
    pairs = np.array(
        [(numbers.setdefault(bytes(term), len(numbers)), names.setdefault(item, len(names))) for item, term in rows],
        np.int64,
    ).reshape(-1, 2)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    start = np.searchsorted(pairs[:, 0], np.arange(len(numbers) + 1))
    return Index(list(names), numbers, start, pairs[:, 1].copy())


TERMS_SEEN = T.StructType([T.StructField("term", T.LongType()), T.StructField("seen", T.LongType())])
DOCUMENTS, WORDS = -1, -2  # in place of a term: how many documents have terms, and how many


def _seen(index):
    """Documents that hold each term of the index, and the corpus totals, of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = index.value.numbers
        seen, totals = np.zeros(len(numbers), np.int64), [0, 0]
        for batch in batches:
            held: list[int] = []
            for text in batch["text"]:
                listed = terms(text.as_py())
                totals[0] += bool(listed)
                totals[1] += len(listed)
                held += [numbers[t] for t in set(listed) if t in numbers]
            seen += np.bincount(held, minlength=len(seen)).astype(np.int64)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([DOCUMENTS, WORDS, *some.tolist()], pa.int64()), pa.array([*totals, *seen[some].tolist()], pa.int64())],
            ["term", "seen"],
        )

    return run


class _Late:
    """Compares the other way round, null first: a heap's least is the worst document."""

    __slots__ = ("key",)

    def __init__(self, value):
        self.key = (value is None, value)

    def __eq__(self, other):
        return self.key == other.key

    def __lt__(self, other):
        if self.key[0] and other.key[0]:
            return False
        return other.key < self.key


def _scores(index: Index, weight: np.ndarray, lists: list[dict], sizes: list[int], exact: bool) -> np.ndarray:
    """Documents by items."""
    counts = np.array([len(found) for found in lists])
    term = np.fromiter((t for found in lists for t in found), np.int64, counts.sum())
    times = np.fromiter((c for found in lists for c in found.values()), np.int64, counts.sum())
    doc = np.repeat(np.arange(len(lists)), counts)
    worth = weight[term] * ((1_000_000_000 * times) // (1000 * times + 8 * np.array(sizes, np.int64)[doc]))
    begin, width = index.start[term], index.start[term + 1] - index.start[term]
    ends = np.cumsum(width)
    place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - width), width)
    cell = np.repeat(doc * len(index.names), width) + index.items[place]
    total = len(lists) * len(index.names)
    if exact:  # every sum is below 2^53
        sums = np.bincount(cell, weights=np.repeat(worth, width), minlength=total).astype(np.int64)
    else:
        sums = np.zeros(total, np.int64)
        np.add.at(sums, cell, np.repeat(worth, width))
    return sums.reshape(len(lists), len(index.names))


def _search(sent, weight: np.ndarray, n_docs: int, n_words: int, best: int, item_type, doc_type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        numbers, n_items = index.numbers, len(index.names)
        widths = np.diff(index.start)
        by_item = np.bincount(index.items, weights=np.repeat(weight, widths), minlength=n_items)
        exact = by_item.max(initial=0) * 1e6 < 2**53
        heaps: list[list] = [[] for _ in range(n_items)]
        least = np.ones(n_items, np.int64)
        ids, lists, sizes, steps = [], [], [], 0

        def flush():
            scores = _scores(index, weight, lists, sizes, exact)
            bar = least
            if len(ids) > best:
                bar = np.maximum(least, np.partition(scores, len(ids) - best, axis=0)[len(ids) - best])
            for row, item in np.argwhere(scores >= bar).tolist():
                heap, entry = heaps[item], (int(scores[row, item]), _Late(ids[row]))
                if len(heap) < best:
                    heapq.heappush(heap, entry)
                elif heap[0] < entry:
                    heapq.heapreplace(heap, entry)
                if len(heap) == best:
                    least[item] = heap[0][0]

        for batch in batches:
            for name, text in zip(batch["doc_id"], batch["text"]):
                listed = terms(text.as_py())
                found = Counter(map(numbers.get, listed))
                found.pop(None, None)
                if not found:
                    continue
                ids.append(name.as_py())
                lists.append(found)
                sizes.append(100 - 90 + (90 * len(listed) * n_docs) // n_words)
                steps += int(widths[list(found)].sum())
                if steps >= STEPS or len(ids) * n_items >= CELLS:
                    flush()
                    ids, lists, sizes, steps = [], [], [], 0
        if ids:
            flush()
        rows = [(index.names[k], entry[1].key[1], entry[0]) for k, heap in enumerate(heaps) for entry in heap]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], item_type),
                pa.array([r[1] for r in rows], doc_type),
                pa.array([r[2] for r in rows], pa.int64()),
            ],
            ["item_id", "doc_id", "score"],
        )

    return run


def _search_block(docs: DataFrame, block: DataFrame, best: int) -> DataFrame:
    spark = docs.sparkSession
    index = _index([(row["item_id"], row["term"]) for row in block.collect()])
    sent = spark.sparkContext.broadcast(index)
    counted = docs.select("text").mapInArrow(_seen(sent), TERMS_SEEN).groupBy("term").agg(F.sum("seen").alias("seen"))
    seen = dict(map(tuple, counted.collect()))  # at most one row for each term of the index
    n_docs, n_words = seen.get(DOCUMENTS, 0), seen.get(WORDS, 0)
    weight = np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * seen.get(t, 0) + 1))) for t in range(len(index.numbers))],
        np.int64,
    )
    id_types = block.schema["item_id"].dataType, docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("item_id", id_types[0]),
            T.StructField("doc_id", id_types[1]),
            T.StructField("score", T.LongType()),
        ]
    )
    search = _search(sent, weight, n_docs, max(n_words, 1), best, *map(to_arrow_type, id_types))
    return docs.select("doc_id", "text").mapInArrow(search, schema)


def best_documents(
    docs: DataFrame, items: DataFrame, best: int = BEST, block_postings: int = BLOCK_POSTINGS
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of each item.

    ``docs`` has ``doc_id, text`` and ``items`` ``item_id, text``; other columns are not
    read.  Scores count rare terms more and repeats and long documents less; all
    documents with terms make the statistics.  Equal scores rank by ``doc_id``,
    null last.  Rows of one ``item_id`` (null too) are one item with the terms of all;
    repeated rows of ``docs`` are documents of their own.  Null and empty texts have no
    terms: such an item has no rows, such a document is never found; with either
    table empty, the result is.  An index holds about ``block_postings`` pairs of
    an item and a term, and at least one item; more items are more passes.
    """
    pairs = T.StructType(
        [T.StructField("item_id", items.schema["item_id"].dataType), T.StructField("term", T.BinaryType())]
    )
    listed = cut_lineage(items.select("item_id", "text").mapInArrow(_item_terms, pairs).distinct())
    blocks = max(1, -(-listed.count() // block_postings))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = None
    for k in range(blocks):
        part = _search_block(docs, listed.where(block == k) if blocks > 1 else listed, best)
        found = part if found is None else found.union(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("item_id", "rank", "doc_id", "score")
