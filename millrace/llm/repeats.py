"""Maximal periodic runs of words, and texts with each run cut to its first period.

Baier's grouping (the first phase of his suffix sorter) gives the Lyndon array of a text
in linear time; under an order and its reverse, every run contains a Lyndon root that
starts where the array says so.  Roots are extended to both sides by the longest common
extensions, found by galloping over the words' numbers.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SHORTEST = 12  # words of the shortest run that counts
FLUSH_BYTES = 8 << 20  # of texts in one batch of results

RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])
ARROW_RUN = pa.struct([pa.field(name, pa.int64(), False) for name in ("start", "length", "period")])


def lyndon_lengths(ids: list[int], kinds: int, reverse: bool = False) -> list[int]:
    """Length of the longest Lyndon word that starts at each place.

    ``ids`` are 0 to ``kinds - 1``, ordered as numbers or the other way round; a text's
    end is smaller than any word.  A group holds the suffixes known to share a prefix (their
    context); groups are linked in their order.  From the highest down, the suffixes of a
    group get their context as answer and leave; the nearest suffix that stays on
    the left of ``k`` of them in a row has its context lengthened by ``k`` such contexts, and
    goes to a new group right above its own: the more contexts, the higher.
    """
    n = len(ids)
    members: list[list[int]] = [[] for _ in range(kinds)]
    for place, kind in enumerate(ids):
        members[kind].append(place)
    length, alive = [1] * kinds, [len(m) for m in members]
    below, above = list(range(-1, kinds - 1)), list(range(1, kinds + 1))
    current = kinds - 1
    if reverse:
        below, above, current = above, below, 0
        below[kinds - 1] = -1
    group = list(ids)
    left, right = list(range(-1, n)), list(range(1, n + 2))  # what has not left yet
    answer = [0] * n
    while current >= 0:
        context = length[current]
        moves: dict[tuple[int, int], list[int]] = {}
        waiting, times = -1, 0
        for place in members[current]:
            if group[place] != current:  # has moved up since
                continue
            answer[place] = context
            before, after = left[place], right[place]
            left[after] = before
            right[before] = after
            if before == waiting:
                times += 1
                continue
            if waiting >= 0:
                moves.setdefault((group[waiting], times), []).append(waiting)
            waiting, times = before, 1
        if waiting >= 0:
            moves.setdefault((group[waiting], times), []).append(waiting)
        members[current] = []
        for key in sorted(moves, reverse=True) if len(moves) > 1 else moves:
            old, times = key
            places = moves[key]
            if len(places) == alive[old]:  # nobody stays: the group itself is lengthened
                length[old] += times * context
                continue
            alive[old] -= len(places)
            new = len(length)
            length.append(length[old] + times * context)
            alive.append(len(places))
            members.append(places)
            over = above[old]
            below.append(old)
            above.append(over)
            below[over] = new
            above[old] = new
            for place in places:
                group[place] = new
        current = below[current]
    return answer


def _right(numbers: bytes, i: int, j: int, end: int) -> int:
    """How many 4-byte numbers from ``i`` and ``j`` on are equal; ``i < j``."""
    begin, step = j, 32
    while j + step <= end and numbers[i : i + step] == numbers[j : j + step]:
        i, j, step = i + step, j + step, step * 2
    while step > 4:
        step //= 2
        if j + step <= end and numbers[i : i + step] == numbers[j : j + step]:
            i, j = i + step, j + step
    return (j - begin) // 4


def _left(numbers: bytes, i: int, j: int) -> int:
    """How many 4-byte numbers up to ``i`` and ``j`` (exclusive) are equal; ``i < j``."""
    begin, step = i, 32
    while step <= i and numbers[i - step : i] == numbers[j - step : j]:
        i, j, step = i - step, j - step, step * 2
    while step > 4:
        step //= 2
        if step <= i and numbers[i - step : i] == numbers[j - step : j]:
            i, j = i - step, j - step
    return (begin - i) // 4


def runs_of(ids: list[int], kinds: int, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of at least ``shortest`` words, in order."""
    n = len(ids)
    if n < shortest:
        return []
    numbers = array("i", ids).tobytes()
    at = np.arange(n)
    padded = np.concatenate([[-1], np.asarray(ids, dtype=np.int64), [-2]])
    found = set()
    for reverse in (False, True):
        root = np.array(lyndon_lengths(ids, kinds, reverse))
        end = at + root
        # A root of a run has an equal word one period away on either side.
        near = (padded[at + 1] == padded[end + 1]) | (padded[at] == padded[end])
        last: dict[int, int] = {}  # period: where its latest run ends
        for i in np.flatnonzero(near).tolist():
            period = int(root[i])
            if last.get(period, -1) >= i + period:  # inside that run
                continue
            more = _right(numbers, 4 * i, 4 * (i + period), 4 * n)
            less = _left(numbers, 4 * i, 4 * (i + period))
            if less + more >= period:
                last[period] = i + period + more
                if less + period + more >= shortest:
                    found.add((i - less, less + period + more, period))
    return sorted(found)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    dropped, kept = 0, []
    for first, end in sorted((start + period, start + length) for start, length, period in runs):
        if first > dropped:
            kept += words[dropped:first]
        dropped = max(dropped, end)
    return b" ".join(kept + words[dropped:])


def _found(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch["doc_id"], batch["text"]
            begin, bulk, rows, cut = 0, 0, [], []
            for k in range(len(batch)):
                # ASCII blanks only, as bytes are split
                words = (texts[k].as_py() or "").encode().split()
                numbers: dict[bytes, int] = {}
                runs = runs_of([numbers.setdefault(w, len(numbers)) for w in words], len(numbers), shortest)
                rows.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                cut.append(collapsed(words, runs).decode())
                bulk += len(cut[-1])
                if bulk >= FLUSH_BYTES or k + 1 == len(batch):
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.slice(begin, k + 1 - begin),
                            pa.array([len(r) for r in rows], pa.int64()),
                            pa.array(rows, pa.list_(ARROW_RUN)),
                            pa.array(cut, pa.string()),
                        ],
                        ["doc_id", "n_runs", "runs", "collapsed"],
                    )
                    begin, bulk, rows, cut = k + 1, 0, [], []

    return run


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """``doc_id, n_runs, runs, collapsed`` for each row of ``docs``.

    ``runs`` holds ``start, length, period`` of each stretch of words that repeats with its
    smallest period at least twice, is at least ``shortest`` words long and cannot be
    extended; ``collapsed`` is the text with single spaces and without what runs repeat.
    Words stand between ASCII blanks.  A text that is null or has no word has no runs
    and collapses to the empty text; repeated rows are rows of their own; other columns
    are not read.  No row moves: a text is worked on where it is read, in memory
    proportional to its words.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_runs", T.LongType()),
            T.StructField("runs", T.ArrayType(RUN, False)),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    return docs.select("doc_id", "text").mapInArrow(_found(shortest), schema)
