"""Words of Arrow text columns as numpy arrays, for functions that run inside tasks.

Texts are worked on in chunks of whole documents, so memory follows the chunk (or the
longest text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, row after the last, bytes, offsets`` of runs of rows of about ``limit`` bytes."""
    data, offsets = flat(column)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``h`` (uint64)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Powers:
    """Powers of the hash base and of its inverse, as many as were asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            factors = np.full(n, BASE, np.uint64)
            factors[0] = 1
            self.up = np.cumprod(factors)
            factors[1:] = BASE_INVERSE
            self.down = np.cumprod(factors)
        return self.up, self.down


def prefix_hashes(data: np.ndarray, powers: Powers) -> np.ndarray:
    """Running polynomial sums; ``(p[b] - p[a]) * down[a]`` hashes ``data[a:b]``."""
    up, _ = powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def _table(ranges: list[tuple[int, int]]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


IS_GAP = _table([(0x20, 0x20), (0x09, 0x0D)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the number of words before each row and in all."""
    solid = ~IS_GAP[data]
    starts, ends = solid.copy(), solid.copy()
    starts[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[first] = solid[first]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[last] = solid[last]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words, A-Z lower-cased, and their offsets by row."""
    starts, ends, rows = word_bounds(data, offsets)
    sums = prefix_hashes(LOWER[data], powers)
    return mixed((sums[ends] - sums[starts]) * powers.down[starts]), rows


def shingle_hashes(words: np.ndarray, rows: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its runs of ``width`` words.

    A row of fewer words has one, of its whole sequence; a row without words has none.
    """
    step = np.uint64(0xD6E8FEB86659FD93)
    rolling = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        rolling = rolling * step + words[k : k + len(rolling)]
    rolling = mixed(rolling)
    for at, to in zip(rows[:-1], rows[1:]):
        if to - at >= width:
            yield np.unique(rolling[at : to - width + 1])
        elif to > at:
            whole = np.uint64(to - at)
            with np.errstate(over="ignore"):
                for word in words[at:to]:
                    whole = whole * step + word
            yield mixed(np.array([whole], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
