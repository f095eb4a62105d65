"""Sets of word shingles as sorted arrays of 64-bit hashes, for a batch of texts at a time.

Words are runs of bytes other than white space (space, and tab to carriage return), with A-Z lower-cased. A word's hash is
a polynomial of random numbers for its bytes; a shingle's combines those of its words by place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes hashed at once.
AT_ONCE = 500_000
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit function of each number (the finaliser of splitmix64; its constants are fixed values)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_SPACES = [32, *range(9, 14)]
BYTES[65:91] = BYTES[97:123]
BYTES[_SPACES] = 0
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[_SPACES] = True
BASE = U(0xD6E8FEB86659FD93)
PLACES = mix(np.arange(1001, 1065, dtype=U)) | U(1)


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of ``data`` (bytes of all texts) and the number of words before each text.

    ``starts`` are the texts' first bytes, and the end of the last.
    """
    inside = ~IS_SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = starts[(starts > 0) & (starts < len(data))]
    begins[edges] |= inside[edges]
    ends[edges - 1] |= inside[edges - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    out = np.empty(len(first), dtype=U)
    a = 0
    while a < len(first):
        b = max(a + 1, int(np.searchsorted(last, first[a] + AT_ONCE)))
        at = first[a:b] - first[a]
        values = BYTES[data[first[a]:last[b - 1] + 1]]
        longest = int((last[a:b] - first[a:b]).max()) + 1
        powers = np.cumprod(np.full(longest, BASE, dtype=U))
        gaps = np.diff(np.append(at, len(values)))
        place = np.minimum(np.arange(len(values)) - np.repeat(at, gaps), longest - 1)
        out[a:b] = mix(np.add.reduceat(values * powers[place], at) + (last[a:b] - first[a:b]).astype(U))
        a = b
    return out, np.searchsorted(first, starts)


def shingle_sets(data: np.ndarray, starts: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each text the distinct shingles of ``k`` words, ascending; of the whole sequence where it has fewer words."""
    words, at = word_hashes(data, starts)
    rows = np.zeros(max(0, len(words) - k + 1), dtype=U)
    for i in range(k):
        rows += words[i:len(words) - k + 1 + i] * PLACES[i]
    rows = mix(rows)
    for a, b in zip(at.tolist(), at[1:].tolist()):
        if b - a >= k:
            own = np.sort(rows[a:b - k + 1])
            fresh = np.ones(len(own), dtype=bool)
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            yield own[fresh]
        elif b > a:
            yield mix((words[a:b] * PLACES[:b - a]).sum(keepdims=True) + U(b - a))
        else:
            yield np.empty(0, dtype=U)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column without nulls and the texts' bounds in them, without copying."""
    import pyarrow as pa

    if column.type != pa.string():
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or len(bounds) == 0:
        return np.empty(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]
