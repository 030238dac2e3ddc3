"""Vectorised word and word-window hashing over Arrow string arrays.

Words are maximal runs of bytes other than space and the five ASCII controls
0x09-0x0D. A window's hash is a difference of two prefix sums of word hashes
times an inverse power of an odd base, all modulo 2**64, so any window costs
the same whatever its length; two independent lanes make 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 2**63, (2, 256), dtype=np.uint64)
_BASE = _RNG.integers(2**40, 2**62, (2, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
        if n > 1 << 22:  # one huge text must not stay in memory
            _POWERS.pop(base)
    return have[:n]


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def spans(sums: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Position-free hash of values[begin:end] from ``prefix`` sums."""
    inverse = pow(base, -1, 1 << 64)
    return (sums[end] - sums[begin]) * powers(inverse, len(sums))[begin]


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary array; nulls are empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at


def blocks(column: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes, one row at least."""
    _, at = string_buffers(column)
    low, n = 0, len(column)
    while low < n:
        high = int(np.searchsorted(at, at[low] + size, side="right")) - 1
        high = min(n, max(low + 1, high))
        yield low, high
        low = high


class Words:
    """Word bounds and hashes of the texts of one Arrow array."""

    def __init__(self, column: pa.Array, lanes: int = 2, fold: bool = False):
        raw, at = string_buffers(column)
        data = raw[at[0] : at[-1]]
        at = at - at[0]
        self.n_texts = len(at) - 1
        solid = ~SPACE[data]
        begin, end = solid.copy(), solid.copy()
        begin[1:] &= ~solid[:-1]
        end[:-1] &= ~solid[1:]
        filled = at[:-1] < at[1:]
        first, last = at[:-1][filled], at[1:][filled] - 1
        begin[first] = solid[first]
        end[last] = solid[last]
        self.begin, self.end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        #: words of text i are first[i] : first[i + 1]
        self.first = np.searchsorted(self.begin, at)
        if fold:
            data = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))
        self.hashes = []
        for lane in range(lanes):
            base = int(_BASE[0, lane])
            self.hashes.append(mix(spans(prefix(_BYTE[lane][data], base), self.begin, self.end, base)))
        self._sums: dict[int, np.ndarray] = {}

    def window_hash(self, begin: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
        base = int(_BASE[1, lane])
        if lane not in self._sums:
            self._sums[lane] = prefix(self.hashes[lane], base)
        return mix(spans(self._sums[lane], begin, end, base) + (end - begin).astype(np.uint64))

    def text_of(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, words, side="right") - 1


def last_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the rightmost minimum of values[i : i + width], for each full window."""
    index, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        if len(values) <= step:
            return np.zeros(0, dtype=np.int64)
        take = values[step:] <= values[:-step]
        values = np.where(take, values[step:], values[:-step])
        index = np.where(take, index[step:], index[:-step])
        reach += step
    return index
