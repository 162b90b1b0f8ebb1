"""Vectorised hashing of many texts at once, for use inside Arrow tasks.

Texts of a batch lie one after another in Arrow's buffer. They are scanned in
blocks of bounded size, so memory does not follow the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK = 1 << 19
_ODD = 0x9E3779B97F4A7C15


def table_of(seed: int) -> np.ndarray:
    """256 fixed random 64-bit values."""
    return np.random.default_rng(seed).integers(0, 2**64, 256, dtype=U64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, and where each row starts (and the last ends).

    Nulls count as empty.
    """
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw, at.astype(np.int64)


class Rolling:
    """Hashes of all windows of a block from prefix sums of a polynomial modulo 2^64."""

    def __init__(self, seed: int, block: int) -> None:
        base = (_ODD * (2 * seed + 1)) % 2**64
        self.table = table_of(seed)
        self.up = powers(base, block + 1)
        self.down = powers(pow(base, -1, 2**64), block + 1)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, U64)
        np.cumsum(self.table[data] * self.up[: len(data)], out=out[1:])
        return out

    def windows(self, prefix: np.ndarray, k: int) -> np.ndarray:
        n = len(prefix) - k
        return (prefix[k:] - prefix[:n]) * self.down[:n]

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self.down[start]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The minimum of every w consecutive values."""
    have, out = 1, x
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(x) - w + 1], out[w - have : w - have + len(x) - w + 1])


def blocks(at: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have up to ``limit`` bytes together, or a single longer text."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
