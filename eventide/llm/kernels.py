"""Vectorised numpy helpers over Arrow string columns; they run inside tasks.

A *block* is a run of consecutive rows whose UTF-8 bytes fit ``BLOCK_BYTES`` (a
longer text is a block of its own), so memory follows the longest text and not
the size of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)

# ASCII white space of the word patterns: space and 0x09-0x0D.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[ord("A"):ord("Z") + 1] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * _U64(_BASE))
_powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    global _powers
    if len(_powers[0]) < n:
        n = max(n, BLOCK_BYTES + 1)
        tables = []
        for base in (_BASE, _INV):
            t = np.full(n, base, dtype=np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers = tables[0], tables[1]
    return _powers


def string_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a null-free string array; offsets start at 0."""
    arr = arr.cast(pa.large_binary())
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    if len(offsets) == 0:
        return np.zeros(1, np.int64), data[:0]
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most ``limit`` bytes, or a single longer row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def word_spans(offsets: np.ndarray, data: np.ndarray, solid: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word of a block: maximal runs of bytes marked in ``solid``.

    A row's end always ends a word.
    """
    n = len(data)
    if n == 0:
        return (np.zeros(0, np.int64),) * 3
    inside = solid[data]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | first[1:n]
    end[:-1] &= ~inside[1:] | first[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span of bytes, lower-cased in ASCII, by prefix sums."""
    n = len(data)
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[ASCII_LOWER[data]] * power[:n], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word of a block; words are runs without ASCII white space."""
    starts, ends, rows = word_spans(offsets, data, ~IS_SPACE)
    return span_hashes(data, starts, ends), rows


def hash_word(word: str) -> int:
    """The hash that ``span_hashes`` gives a single word."""
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(span_hashes(raw, np.array([0]), np.array([len(raw)]))[0])


def shingle_hashes(h: np.ndarray, rows: np.ndarray, n_rows: int, k: int
                   ) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hash, row) of every run of ``k`` words; a row with fewer words is one shingle."""
    counts = np.bincount(rows, minlength=n_rows)
    m = len(h)
    odd = [_U64(pow(_BASE, 2 * j + 3, 1 << 64)) for j in range(k)]
    if m >= k:
        s = np.full(m - k + 1, k, dtype=np.uint64)
        for j in range(k):
            s += h[j:m - k + 1 + j] * odd[j]
        whole = rows[:m - k + 1] == rows[k - 1:]
        out, out_rows = mix64(s[whole]), rows[:m - k + 1][whole]
    else:
        out, out_rows = h[:0], rows[:0]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        at = np.concatenate(([0], np.cumsum(counts)))
        extra = np.empty(len(short), dtype=np.uint64)
        for i, r in enumerate(short):
            ws = h[at[r]:at[r + 1]]
            extra[i] = np.sum(ws * np.array(odd[:len(ws)]), dtype=np.uint64) + _U64(len(ws))
        out = np.concatenate((out, mix64(extra)))
        out_rows = np.concatenate((out_rows, short))
        order = np.argsort(out_rows, kind="stable")
        out, out_rows = out[order], out_rows[order]
    return out, out_rows


def distinct_sets(offsets: np.ndarray, data: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row of a block."""
    n_rows = len(offsets) - 1
    s, rows = shingle_hashes(*word_hashes(offsets, data), n_rows, k)
    cuts = np.searchsorted(rows, np.arange(n_rows + 1))
    return [np.unique(s[cuts[i]:cuts[i + 1]]) for i in range(n_rows)]


def binary_column(rows: list[np.ndarray]) -> pa.Array:
    """A binary column of the raw little-endian bytes of each array."""
    return pa.array([r.tobytes() for r in rows], type=pa.binary())
