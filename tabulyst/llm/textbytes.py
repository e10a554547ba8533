"""Words and windows of whole texts as NumPy arrays, straight from Arrow's UTF-8 buffers.

A batch of texts is one run of bytes with row offsets. Words are found by a table over byte values,
hashed to 64 bits by prefix sums, and combined to window hashes; nothing here is a Python loop over
words. Rows are handled in chunks of a few MB, so that memory doesn't grow with the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 2 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_FIRST, _SECOND = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: Byte values after A-Z are lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Digits, letters and all of the bytes above 127.
ALNUM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
#: Everything but blanks, tabs and line ends.
NONSPACE = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64, in place."""
    x ^= x >> np.uint64(30)
    x *= _FIRST
    x ^= x >> np.uint64(27)
    x *= _SECOND
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: Odd factors of the words' places in a window.
_PLACES = mix(np.arange(1000, 1064, dtype=np.uint64)) | np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the odd base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_ODD, _INVERSE)):
            steps = np.full(max(n, CHUNK + 1), base)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `limit` bytes; a longer row is alone."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, high
        low = high


def _hash_tile(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _powers(len(raw))
    value = _BYTES[raw]
    value *= power
    total = np.cumsum(value, dtype=np.uint64)
    return mix((total[ends - 1] - total[starts] + value[starts]) * inverse[starts])


@dataclass
class Words:
    """Words of some rows: bytes counted as, [start, end) of each word, hash, first word of each row."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray  # len(rows) - 1 rows; row r has words rows[r]:rows[r + 1]

    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def text(self, word: int, n: int) -> bytes:
        """n words from `word` on, joined by one blank."""
        return b" ".join(self.raw[s:e].tobytes() for s, e in zip(self.starts[word : word + n], self.ends[word : word + n]))


def split_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lower: np.ndarray = LOWER) -> Words:
    """Words of each row: longest runs of bytes for which `inside` holds; hashed after `lower`."""
    raw, within = lower[data], inside[data]
    first, last = within.copy(), within.copy()
    first[1:] &= ~within[:-1]
    last[:-1] &= ~within[1:]
    filled = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    first[heads], last[tails] = within[heads], within[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    del first, last, within
    hashes, low = np.empty(len(starts), np.uint64), 0
    while low < len(starts):  # by whole words of about CHUNK bytes: one very long row needs no more memory
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + 2 * CHUNK, "right")))
        at = starts[low]
        hashes[low:high] = _hash_tile(raw[at : ends[high - 1]], starts[low:high] - at, ends[low:high] - at)
        low = high
    return Words(raw, starts, ends, hashes, np.searchsorted(starts, offsets))


def windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every run of n words that lies in one row."""
    total = len(words.hashes) - n + 1
    if total <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    out = words.hashes[:total] * _PLACES[0]
    for i in range(1, n):
        out += words.hashes[i : i + total] * _PLACES[i % 64]
    fits = np.ones(total, bool)
    for i in range(1, n):  # the last n - 1 words of each row start none
        at = words.rows[1:] - i
        at = at[(at >= 0) & (at < total)]
        fits[at] = False
    first = np.flatnonzero(fits)
    return first, mix(out[first] + np.uint64(n))


def run_hashes(words: Words, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of the words low:high of each pair, whatever their number (high > low)."""
    if not len(low):
        return np.empty(0, np.uint64)
    power, inverse = _powers(len(words.hashes))
    value = words.hashes * power
    total = np.cumsum(value, dtype=np.uint64)
    out = (total[high - 1] - total[low] + value[low]) * inverse[low]
    return mix(out ^ ((high - low).astype(np.uint64) * _FIRST))


class HashSet:
    """Membership of 64-bit hashes: one bit table turns most away before the sorted search."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values.astype(np.uint64))
        self.shift = np.uint64(64 - min(24, max(12, int(len(self.values)).bit_length() + 4)))
        self.table = np.zeros(1 << int(64 - self.shift), bool)
        self.table[self.values >> self.shift] = True

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        out = self.table[hashes >> self.shift]
        if len(self.values):
            maybe = np.flatnonzero(out)
            at = np.minimum(np.searchsorted(self.values, hashes[maybe]), len(self.values) - 1)
            out[maybe] = self.values[at] == hashes[maybe]
        return out
