"""Words and shingles of a block of texts as numpy arrays, without a Python loop over words.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return;
only the letters A-Z are lower-cased. Both rules work on UTF-8 bytes, so no text is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: One random number for every byte value, and the step of the position factors.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def _position_factors(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 256), _STEP, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the place where each begins (one more for the end); null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole, starts


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about `limit` bytes: first row, row after the last, their bytes, and where each begins."""
    whole, starts = utf8(column)
    row, rows = 0, len(column)
    while row < rows:
        end = int(np.searchsorted(starts, starts[row] + limit, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, whole[starts[row] : starts[end]], starts[row : end + 1] - starts[row]
        row = end


#: For terms of prose: ASCII punctuation and control characters separate words, too.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_spans(data: np.ndarray, starts: np.ndarray, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and the number of words before each text (one more for all)."""
    inside = ~blank[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    if len(data):
        cut = starts[:-1][starts[:-1] < len(data)]
        before[cut] = False
        after[cut - 1] = False  # -1 is the last byte: no text follows it
        after[-1] = False
    begin = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return begin, end, np.searchsorted(begin, starts)


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_hashes(data: np.ndarray, starts: np.ndarray, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray]:
    """64-bit value of each lower-cased word, and the number of words before each text (one more for all)."""
    begin, end, first = word_spans(data, starts, blank)
    return hash_spans(_LOWER[data], begin, end), first


def hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit value of the bytes between each begin and end."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    length = end - begin
    factors = _position_factors(int(length.max()))
    at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    values = _BYTE[data[np.repeat(begin, length) + at]] * factors[at]
    return mix(np.add.reduceat(values, np.cumsum(length) - length) + length.astype(np.uint64))


def shingle_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Value of each run of n words, text by text, and the number of runs before each text.

    A text of fewer words has its whole sequence as the only run; a text without words has none.
    """
    count = np.diff(first)
    runs = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    total = np.concatenate(([0], np.cumsum(runs)))
    at = np.repeat(first[:-1] - total[:-1], runs) + np.arange(total[-1])
    width = np.repeat(np.minimum(count, n), runs)
    value = np.zeros(len(at), np.uint64)
    padded = np.concatenate((words, np.zeros(n, np.uint64)))
    for k in range(n):
        here = np.where(width > k, padded[at + k], np.uint64(0)) if (width < n).any() else padded[at + k]
        value = value * np.uint64(0xD6E8FEB86659FD93) + here
    return mix(value + width.astype(np.uint64)), total


def sorted_sets(values: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text in ascending order, and the number of values before each text."""
    values = values.copy()
    for a, b in zip(total[:-1].tolist(), total[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[total[:-1][total[:-1] < len(values)]] = True
    return values[keep], np.concatenate(([0], np.cumsum(keep)))[total]
