"""Vectorised hashes of words and byte windows of Arrow text columns.

A polynomial hash modulo 2**64 is kept as prefix sums, so the hash of any stretch of
bytes is one difference; `mix` spreads it over all bits afterwards.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SEGMENT = 1 << 17
U = np.uint64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = U(pow(int(BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate(([U(1)], np.full(size, BASE, U))), dtype=U)
        down = np.cumprod(np.concatenate(([U(1)], np.full(size, inverse, U))), dtype=U)
    return up, down


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse up to `size`, from a few cached lengths."""
    return _powers(1 << max(18, int(size).bit_length()))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * base**position before each position."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, dtype=U)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=out[1:])
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; a null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, A-Z lowered, and the number of words before each row.

    Words are runs of bytes other than space and 09 to 0D. The bytes are hashed in
    segments that end between words, so that memory follows the segment.
    """
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    inside = ~space
    starts = np.flatnonzero(inside & (edge[:-1] | np.concatenate(([True], space[:-1])))) if len(data) else np.zeros(0, int)
    ends = np.flatnonzero(inside & (edge[1:] | np.concatenate((space[1:], [True])))) + 1 if len(data) else starts
    out = np.empty(len(starts), dtype=U)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + SEGMENT, "right")))
        begin, end = int(starts[low]), int(ends[high - 1])
        sums = prefix_sums(_LOWER[data[begin:end]])
        s, e = starts[low:high] - begin, ends[low:high] - begin
        _, down = powers(end - begin)
        with np.errstate(over="ignore"):
            out[low:high] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U) * U(0xD6E8FEB86659FD93))
        low = high
    return out, np.searchsorted(starts, offsets, "left")
