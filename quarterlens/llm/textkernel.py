"""Vectorised word hashing over Arrow string columns.

Words are runs without ASCII white space, lower-cased A-Z only, hashed to 64
bits by a polynomial over the word's bytes.  The polynomials of all words of a
block come from one running sum over the block's bytes, so the cost per byte
is a handful of numpy passes and no Python object is made per word.  Blocks
are about one MB; a longer text is cut at white space, so memory does not grow
with the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        _powers[:] = []
        for base in (_BASE, _BASE_INV):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers.append(np.cumprod(steps, dtype=np.uint64))
    return _powers


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls become empty texts."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8), offsets


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a block of texts, and each text's first word.

    ``offsets`` delimit the texts inside ``data``; the second result has one
    entry more than there are texts.
    """
    data = data[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~is_space(data)
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = word[edges]
    edges = offsets[1:][offsets[1:] > 0] - 1
    last[edges] = word[edges]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    lower = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    return hashes, np.searchsorted(starts, offsets)


def piece_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the given byte ranges, letters as they are."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(column: pa.Array) -> Iterator[np.ndarray]:
    """The word hashes of each text of a string column, in order."""
    data, offsets = string_buffers(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        if offsets[row + 1] - offsets[row] > BLOCK:
            yield _long_text(data[offsets[row]:offsets[row + 1]])
            row += 1
            continue
        stop = max(int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1, row + 1)
        hashes, at = hash_words(data, offsets[row:stop + 1])
        for a, b in zip(at[:-1], at[1:]):
            yield hashes[a:b]
        row = stop


def _long_text(data: np.ndarray) -> np.ndarray:
    parts, start = [], 0
    while start < len(data):
        stop = min(start + BLOCK, len(data))
        while stop < len(data):  # cut at white space, or wait for some
            spaces = np.flatnonzero(is_space(data[start:stop]))
            if len(spaces):
                stop = start + int(spaces[-1]) + 1
                break
            stop = min(stop + BLOCK, len(data))
        parts.append(hash_words(data, np.array([start, stop]))[0])
        start = stop
    return np.concatenate(parts)


_SHINGLE = mix(np.arange(1, 6, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def shingle_set(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` (at most five) words.

    Fewer words make one shingle of the whole sequence; no words make none.
    """
    n = len(words)
    if not n:
        return words
    w = min(n, width)
    total = np.full(n - w + 1, w, dtype=np.uint64)
    for k in range(w):
        total += words[k:n - w + 1 + k] * _SHINGLE[k]
    return np.unique(mix(total))
