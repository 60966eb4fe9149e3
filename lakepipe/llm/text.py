"""Words of Arrow text batches as numpy arrays.

A word is a maximal run of bytes other than space and ``\\x09-\\x0D``; A-Z are
lower-cased.  Bytes of UTF-8 are never split inside a character by this rule,
so everything works on the raw Arrow buffer and no Python string is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SEGMENT = 1 << 20  # bytes hashed at once; a longer word is hashed in one piece
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, dtype=bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False

_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    got = _powers.get(name)
    if got is None or len(got) < n:
        steps = np.full(max(n, _SEGMENT), base, dtype=np.uint64)
        steps[0] = 1
        got = _powers[name] = np.multiply.accumulate(steps)
    return got


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    arr = column.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    _, offsets, data = arr.buffers()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text each (a longer text comes alone)."""
    _, off = texts(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


LETTERS = _WORD.copy()  # as words, but ASCII punctuation ends a run too
LETTERS[[b for b in range(128) if not chr(b).isalnum()]] = False


def word_bounds(data: np.ndarray, off: np.ndarray, table: np.ndarray = _WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (one more at the end)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = table[data]
    cut = np.zeros(n + 1, bool)  # a text starts here
    cut[off] = True
    left = np.empty(n, bool)
    left[0] = True
    np.logical_not(word[:-1], out=left[1:])
    left |= cut[:n]
    starts = np.flatnonzero(word & left)
    right = np.empty(n, bool)
    right[-1] = True
    np.logical_not(word[1:], out=right[:-1])
    right |= cut[1:]
    ends = np.flatnonzero(word & right) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each byte span, A-Z lower-cased unless ``lower`` is off; spans are sorted and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        a = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, a + _SEGMENT, side="right")))
        b = int(ends[to - 1])
        values = (_LOWER[data[a:b]] if lower else data[a:b]).astype(np.uint64)
        values += np.uint64(1)
        values *= _power(_BASE, "up", b - a)[: b - a]
        total = np.empty(b - a + 1, np.uint64)
        total[0] = 0
        np.cumsum(values, out=total[1:])
        s = starts[at:to] - a
        out[at:to] = (total[ends[at:to] - a] - total[s]) * _power(_INVERSE, "down", b - a)[s]
        at = to
    out += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(out)


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and for each text the index of its first word (one more at the end)."""
    starts, ends, first = word_bounds(data, off)
    return span_hashes(data, starts, ends), first


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that start at each position (across texts too: the caller keeps those inside one)."""
    size = max(0, len(words) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out *= np.uint64(0xFF51AFD7ED558CCD)
        out += words[k : k + size]
    return mix(out)


def prefix_hashes(words: np.ndarray) -> np.ndarray:
    """Sums from which ``run_hashes`` takes the hash of a run of any length."""
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum((words + np.uint64(1)) * _power(_BASE, "up", len(words))[: len(words)], out=total[1:])
    return total


def run_hashes(sums: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that start at each of the positions."""
    return mix((sums[at + n] - sums[at]) * _power(_INVERSE, "down", len(sums))[at])


def shingle_sets(words: np.ndarray, first: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its n-word shingles.

    A text with fewer words has one shingle, its whole sequence; a text
    without words has none.
    """
    grams = gram_hashes(words, n)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:
            yield gram_hashes(words[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)
