"""Words of whole texts as 64-bit numbers, computed for many texts at once.

A word is a run of bytes other than space and \\x09-\\x0D (``[^\\x20\\x09-\\x0D]+``;
in UTF-8 those are the same characters).  Its number is the sum over its bytes of
a random number of the byte times a random odd number of the place in the word,
mixed at the end with the length.  The numbers of places have no structure (powers
of a base would let words of Thue and Morse meet), so two different words get the
same number with probability about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Multipliers of the places in a sequence of words.
PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_places: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _place_numbers(n: int) -> np.ndarray:
    """Random odd numbers of the places in a word."""
    if len(_places.get("odd", ())) < n:
        _places["odd"] = mix(np.arange(n, dtype=np.uint64) + np.uint64(_BASE)) | np.uint64(1)
    return _places["odd"]


def _chunk_hashes(data: np.ndarray, breaks: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of one stretch of bytes and the place of each word's first
    byte; ``breaks``: places at which a new text begins."""
    if lower:
        data = _LOWER[data]
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[breaks] = True
    edge[0] = edge[-1] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:]))
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    lengths = ends - starts + 1
    first = np.cumsum(lengths) - lengths  # letters of all words without what is between them
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    total = np.add.reduceat(_BYTE[data[word]] * _place_numbers(int(lengths.max()))[place], first)
    return mix(total + lengths.astype(np.uint64)), starts


def hashed_texts(column: pa.Array, lower: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, offsets, word numbers)`` for stretches of rows of a string
    column: text ``first + i`` has the numbers ``offsets[i]`` to ``offsets[i + 1]``.
    A null text has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + CHUNK_BYTES, "right")) - 1)
        last = min(last, n)
        part = data[ends[first] : ends[last]]
        breaks = ends[first : last + 1] - ends[first]
        numbers, starts = [], []
        low = 0
        while low < len(part):  # more than once for a very long text only
            high = min(len(part), low + 2 * CHUNK_BYTES)
            if high < len(part):
                gaps = np.flatnonzero(_SPACE[part[low:high]])
                if len(gaps):
                    high = low + int(gaps[-1]) + 1
                else:  # a word longer than the stretch is taken whole
                    rest = np.flatnonzero(_SPACE[part[high:]])
                    high = high + int(rest[0]) + 1 if len(rest) else len(part)
            inside = breaks[(breaks >= low) & (breaks <= high)] - low
            got, at = _chunk_hashes(part[low:high], inside, lower)
            numbers.append(got)
            starts.append(at + low)
            low = high
        all_numbers = np.concatenate(numbers) if numbers else np.zeros(0, np.uint64)
        all_starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        yield first, np.searchsorted(all_starts, breaks), all_numbers
        first = last


def sequence_hashes(numbers: np.ndarray, length: int) -> np.ndarray:
    """Numbers of all runs of ``length`` consecutive words."""
    n = len(numbers) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, length, np.uint64)
    for j in range(length):
        total += mix(numbers[j : j + n] + PLACE[j]) * PLACE[j]
    return mix(total)


def shingle_set(numbers: np.ndarray, width: int) -> np.ndarray:
    """Distinct shingles of a text, ascending; a text with fewer words than
    ``width`` is one shingle, a text without words none."""
    if not len(numbers):
        return np.zeros(0, np.uint64)
    return np.unique(sequence_hashes(numbers, min(width, len(numbers))))


def texts_shingles(column: pa.Array, width: int, lower: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, distinct shingles)`` for every row of a string column."""
    for first, offsets, numbers in hashed_texts(column, lower):
        runs = sequence_hashes(numbers, width)
        for i in range(len(offsets) - 1):
            low, high = offsets[i], offsets[i + 1]
            if high - low >= width:
                yield first + i, np.unique(runs[low : high - width + 1])
            else:
                yield first + i, shingle_set(numbers[low:high], width)
