"""Vectorised text kernels shared by the operators (numpy over Arrow buffers).

Everything works on a block of texts at a time: the UTF-8 bytes of many texts
lie in one array, and word boundaries, word hashes and window hashes come from
a few passes over it.  Blocks are cut by bytes, so memory does not depend on
how many or how long the rows of an Arrow batch are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C55 | 1
_MASK = (1 << 64) - 1
_tables: dict[str, np.ndarray] = {}

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII characters that are neither letters nor digits; all other bytes belong to words.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads a weak hash over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i modulo 2^64 for i < n (B is odd, so it has an inverse)."""
    if "up" not in _tables or len(_tables["up"]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            table = np.ones(size, dtype=np.uint64)
            done = 1
            while done < size:
                table[done:2 * done] = table[:done] * np.uint64(pow(base, done, 1 << 64) & _MASK)
                done *= 2
            _tables[name] = table
    return _tables["up"][:n], _tables["down"][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes, so any window's hash is one subtraction away."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=out[1:])
    return out


def window_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair, the same wherever the bytes stand."""
    _, down = powers(len(sums))
    return (sums[end] - sums[start]) * down[start]


def utf8_column(column) -> pa.Array:
    """The column as one large-binary array; null texts become empty ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary()).fill_null(b"")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a large-binary array."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, ends


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows holding about ``limit`` bytes."""
    raw, ends = buffers(column)
    row, n = 0, len(column)
    while row < n:
        stop = int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1
        stop = min(n, max(stop, row + 1))
        yield row, stop, raw[ends[row]:ends[stop]], ends[row:stop + 1] - ends[row]
        row = stop


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACES) -> tuple[
        np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ASCII-lower-cased words of a block: runs without ``breaks`` (by default ASCII white space).

    Returns the starts and ends in the block, the 64-bit hashes, and the index of
    the first word of each row (one more entry than rows).
    """
    n = len(data)
    if n == 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    inside = ~breaks[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    hashes = mix(window_hash(prefix_sums(LOWER[data]), starts, ends))
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
