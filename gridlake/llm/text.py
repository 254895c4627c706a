"""Words, lines and shingles of Arrow text columns, found with whole-array numpy steps.

Every function works on one *chunk*: a few megabytes of UTF-8 bytes of consecutive rows, so that memory
stays bounded whatever the number of rows in an Arrow batch. A single text longer than a chunk is a chunk
of its own; texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = 0x9E3779B97F4A7C15 | 1
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Chunk:
    """Bytes of the rows ``first`` .. ``first + len(offsets) - 2`` of a batch; row i is data[offsets[i]:offsets[i + 1]]."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a text column (null: empty) into chunks of whole rows with at most ``limit`` bytes, or one row.

    What Arrow holds of earlier batches goes back to the system first, since a worker's memory counts with its executor's.
    """
    pa.default_memory_pool().release_unused()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield Chunk(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_STEP ** i and its inverse modulo 2 ** 64, for i below n."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((_STEP, pow(_STEP, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


class SpanHasher:
    """64-bit hashes of arbitrary byte spans of one chunk, from prefix sums of a polynomial modulo 2 ** 64."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_CODE[data] * up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words of a chunk in order: byte spans, the row of each, its hash, and the words before each row."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    code: np.ndarray
    before: np.ndarray


def _spans(inside: np.ndarray, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; a run never crosses a row's border."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    borders = chunk.offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(inside))]
    begins[borders] = inside[borders]
    ends[borders - 1] = inside[borders - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def byte_runs(chunk: Chunk, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chunk's bytes with A-Z in lower case, and starts and ends of the runs of bytes that ``inside`` (256 flags) has."""
    data = _LOWER[chunk.data]
    return data, *_spans(inside[data], chunk)


def words(chunk: Chunk, lower: bool = False) -> Words:
    """Runs of bytes other than space and the five control characters 9 to 13; ``lower`` maps A-Z to a-z first."""
    data = _LOWER[chunk.data] if lower else chunk.data
    start, end = _spans(~_SEPARATOR[data], chunk)
    row = np.searchsorted(chunk.offsets[1:], start, "right")
    before = np.searchsorted(start, chunk.offsets, "left")
    return Words(start, end, row, SpanHasher(data)(start, end), before)


def is_separator(data: np.ndarray) -> np.ndarray:
    return _SEPARATOR[data]


_PLACE = mix(np.arange(1, 65, dtype=np.uint64) * _U(0xD1342543DE82EF95)) | _U(1)


def phrase_codes(code: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive words, also across rows. k is at most 64; there must be k words."""
    n = len(code) - k + 1
    total = code[:n] * _PLACE[0]
    for j in range(1, k):
        total = total + code[j : j + n] * _PLACE[j]
    return mix(total + _U(k))


def runs(code: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of all runs of k consecutive words of one row. k is at most 64."""
    n = len(code) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    return at, phrase_codes(code, k)[at]


def shingle_sets(chunk: Chunk, k: int, lower: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of the chunk its index and the sorted distinct hashes of its k-word shingles.

    A row with 1 to k - 1 words has one shingle, the whole sequence; a row without words has none.
    """
    found = words(chunk, lower)
    at, code = runs(found.code, found.row, k)
    cut = np.searchsorted(at, found.before)
    for i in range(len(chunk)):
        first, last = found.before[i], found.before[i + 1]
        if last - first >= k:
            yield i, np.unique(code[cut[i] : cut[i + 1]])
        elif last > first:
            yield i, runs(found.code[first:last], found.row[first:last], int(last - first))[1]
        else:
            yield i, np.zeros(0, np.uint64)


def lines(chunk: Chunk, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines (split at line feeds) that hold a word: row, hash of the whole line, its number of words, and its start."""
    data = chunk.data
    breaks = np.flatnonzero(data == 10)
    start = np.union1d(chunk.offsets[:-1], breaks + 1)
    start = start[start < len(data)]
    row = np.searchsorted(chunk.offsets[1:], start, "right")
    if not len(start):
        return row, np.zeros(0, np.uint64), row, start
    end = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, start)], chunk.offsets[row + 1])
    size = np.searchsorted(found.start, end) - np.searchsorted(found.start, start)
    worded = size > 0
    return row[worded], SpanHasher(data)(start[worded], end[worded]), size[worded], start[worded]
