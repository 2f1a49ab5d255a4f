"""Periodic runs of words against every definition spelled out."""

import hashlib
import random
import zlib

import pytest

import __spark_entry__ as contract
from millrace.llm import repeats
from tests.llm import odd


def plain_lyndon(ids, reverse):
    """The longest Lyndon word at each place: up to the next smaller suffix."""
    key = [-c if reverse else c for c in ids]
    n = len(key)
    return [next((j - i for j in range(i + 1, n) if key[j:] < key[i:]), n - i) for i in range(n)]


def plain_runs(words, shortest=12):
    n, found = len(words), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(2 * q, shortest):
                found.add((i, j + q - i, q))
            i = max(j, i) + 1
    smallest = {}
    for start, length, q in found:
        smallest[(start, length)] = min(q, smallest.get((start, length), q))
    # a stretch counts with its smallest period only
    return sorted(
        (s, n, q) for s, n, q in found
        if not any(p < q and s2 <= s and s + n <= s2 + n2 for s2, n2, p in found)
    )


def texts():
    pick = random.Random(5)
    for size in range(1, 40):
        yield [pick.randrange(3) for _ in range(size)]
        yield [0] * size
        yield list(range(size))
        yield list(range(size))[::-1]
    for _ in range(300):
        size = pick.randrange(1, 60)
        some = [pick.randrange(pick.choice([1, 2, 4])) for _ in range(pick.randrange(1, 6))]
        yield [some[k % len(some)] if pick.random() > 0.03 else pick.randrange(4) for k in range(size)]
    a, b = [0], [0, 1]
    for _ in range(6):
        a, b = b, b + a
    yield b


def test_lyndon_lengths_by_grouping():
    for ids in texts():
        order = {c: k for k, c in enumerate(sorted(set(ids)))}
        ids = [order[c] for c in ids]
        for reverse in (False, True):
            assert repeats.lyndon_lengths(ids, len(order), reverse) == plain_lyndon(ids, reverse)


@pytest.mark.parametrize("shortest", [2, 12])
def test_runs_equal_plain_search(shortest):
    for ids in texts():
        order = {}
        ids = [order.setdefault(c, len(order)) for c in ids]
        assert repeats.runs_of(ids, len(order), shortest) == plain_runs(ids, shortest)


def test_long_texts_take_linear_time():
    assert repeats.runs_of([0] * 300_000, 1) == [(0, 300_000, 1)]
    ids = [k % 1000 for k in range(300_000)]
    assert repeats.runs_of(ids, 1000) == [(0, 300_000, 1000)]


def test_collapsed():
    words = [b"a", b"b", b"a", b"b", b"a", b"c"]
    assert repeats.collapsed(words, [(0, 5, 2)]) == b"a b c"
    assert repeats.collapsed(words, []) == b"a b a b a c"
    assert repeats.collapsed([], []) == b""


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words) if n < 3000 else repeats.runs_of(*numbered(words))
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    s, m, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    listed = "".join("%d,%d,%d\n" % r for r in runs)
    digests = [hashlib.sha256(x).hexdigest() for x in (listed.encode(), b" ".join(kept))]
    return (doc_id, len(runs), s, m, q, 1000 * m // q if runs else None, *digests)


def numbered(words):
    order = {}
    return [order.setdefault(w, len(order)) for w in words], len(order)


def test_query_equals_plain_search(spark, tmp_path):
    extra = [(k, odd.prose(k, 5) + " " + "ab cd  ef\n" * 9 + odd.prose(k, 4), None, None, 0, 1, 2, 3, 4, 0.5) for k in range(200, 260)]
    odd.documents(spark, odd.rows() + extra).write.parquet(f"{tmp_path}/documents.parquet")
    found = contract.queries()["op13_periodic_runs"](spark, str(tmp_path)).collect()
    wanted = [expected(row[0], row[1]) for row in odd.rows() + extra]
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    assert sum(row.n_runs > 0 for row in found) > 60


def test_empty_table(spark):
    assert repeats.periodic_runs(odd.documents(spark, []).limit(0)).collect() == []
