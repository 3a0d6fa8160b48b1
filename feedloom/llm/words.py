"""Words and word n-grams of whole Arrow text batches, hashed without a Python loop over words.

A word is a maximal run of characters that are not U+0020 or U+0009 to U+000D; A-Z are
lower-cased. All of it is done on the UTF-8 bytes of the column, where those characters are
single bytes that occur in no other character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18  # some twenty times as much is held while a chunk is worked on

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_BYTE = _BYTE[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_PLACE = np.random.default_rng(21).integers(1, 1 << 63, 64, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_powers: list[np.ndarray] = []


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse modulo 2^64, up to ``size``."""
    if not _powers or len(_powers[0]) < size:
        size = max(size, CHUNK_BYTES)
        up, down = np.full(size, _BASE, dtype=_U), np.full(size, pow(_BASE, -1, 1 << 64), dtype=_U)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U)]
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of ``h`` over all 64."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of runs of whole texts of about CHUNK_BYTES; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.empty(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        end = min(end, n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of every word, and where each text's words begin (with the end appended)."""
    size = len(data)
    if not size:
        return np.empty(0, _U), np.zeros(len(bounds), dtype=np.int64)
    space = _SPACE[data]
    first, last = ~space, ~space
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    edges = bounds[(bounds > 0) & (bounds < size)]
    first[edges] = ~space[edges]
    last[edges - 1] = ~space[edges - 1]
    begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _tables(size + 1)
    sums = np.zeros(size + 1, dtype=_U)
    np.cumsum(_BYTE[data] * up[:size], dtype=_U, out=sums[1:])
    h = (sums[ends] - sums[begins]) * down[begins]
    return mixed(h + (ends - begins).astype(_U) * _PLACE[0]), np.searchsorted(begins, bounds)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text, its distinct k-word n-grams as sorted 64-bit hashes.

    A text of fewer than k words has one n-gram, its whole sequence; one without words has none.
    """
    for row, end, data, bounds in text_chunks(column):
        words, at = word_hashes(data, bounds)
        grams = np.zeros(max(0, len(words) - k + 1), dtype=_U)
        for j in range(k):
            grams += words[j : j + len(grams)] * _PLACE[1 + j % 60]
        grams = mixed(grams)
        for i in range(end - row):
            a, b = at[i], at[i + 1]
            if b - a >= k:
                own = np.sort(grams[a : b - k + 1])
                new = np.empty(len(own), dtype=bool)
                new[0] = True
                np.not_equal(own[1:], own[:-1], out=new[1:])
                yield own[new]
            elif b > a:
                whole = (words[a:b] * _PLACE[1 : 1 + b - a]).sum(keepdims=True, dtype=_U)
                yield mixed(whole + np.array([b - a], dtype=_U) * _PLACE[62])
            else:
                yield np.empty(0, dtype=_U)
