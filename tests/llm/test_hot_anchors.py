"""Long repeats whose anchor has more extracts than a shard holds."""

from __future__ import annotations

import hashlib
from collections import Counter

from millrace.llm import suffix
from tests.llm.odd import documents, prose
from tests.llm.test_operators import brute_removed


def listed():
    shared = prose(2, 60)
    texts = [prose(500 + k, 20) + " " + shared + " " + prose(900 + k, 20) for k in range(60)]
    texts += texts[:3] + [texts[0] + " " + texts[1], "ab" * 300]
    return [(k, text, None, None, 0, 0, 0, 0, 0, 0.0) for k, text in enumerate(texts)]


def test_no_task_gets_all_extracts_of_an_anchor(spark, monkeypatch):
    monkeypatch.setattr(suffix, "SHARD_BYTES", 8000)
    bodies = [r[1].encode() for r in listed()]
    expected = Counter()
    for (doc_id, *_), body, cover in zip(listed(), bodies, brute_removed(bodies, 200)):
        kept = bytes(x for x, c in zip(body, cover) if not c)
        spans = sum(1 for k in range(len(cover)) if cover[k] and not (k and cover[k - 1]))
        expected[doc_id, len(body), sum(cover), spans, hashlib.sha256(kept).hexdigest()] += 1
    used = []
    hot = suffix._hot_repeats
    monkeypatch.setattr(suffix, "_hot_repeats", lambda *given: used.append(1) or hot(*given))
    assert Counter(tuple(r) for r in suffix.removal_digests(documents(spark, listed())).collect()) == expected
    assert used


def test_a_part_filled_shard_is_closed(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(suffix, "SHARD_BYTES", 1000)
    sizes = []
    monkeypatch.setattr(
        suffix, "_shard_repeats",
        lambda shards, length: sizes.extend(sum(len(r[2]) for r in s) for s in shards) or iter(()),
    )
    rows = [(1, 0, b"x" * 300)] + [(2, k, b"y" * 300) for k in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["anchor", "extract", "body"])
    list(suffix._compare_extracts(200)(iter([batch])))
    assert sum(sizes) == 41 * 300 and max(sizes) < 1300
