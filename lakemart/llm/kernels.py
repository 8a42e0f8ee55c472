"""Array kernels over the bytes of many texts at once: blocks, word bounds, substring digests.

A digest of bytes [a, b) is a difference of two prefix sums of a polynomial modulo
2**64, scaled back to position 0 and mixed. All tables come from fixed seeds, so every
task computes the same digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits (a bijection)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit numbers."""
    return mixed(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


BYTE_VALUE = stream(256, 11)
BASE = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)
LENGTH_SALT = _U(0xA0761D6478BD642F)
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        steps = np.full(size, base, dtype=_U)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=_U)
    return have[:n]


class Digests:
    """64-bit digests of any byte ranges of one buffer."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=_U)
        np.cumsum(BYTE_VALUE[data] * _power_table(BASE, n), dtype=_U, out=self.sums[1:])
        self.back = _power_table(INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mixed(raw + (ends - starts).astype(_U) * LENGTH_SALT)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, end row, bytes, row offsets. Nulls are empty."""
    filled = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(filled.type) or pa.types.is_large_binary(filled.type)
    rows = len(filled)
    if not rows:
        return
    bounds = np.frombuffer(filled.buffers()[1], dtype=np.int64 if wide else np.int32)
    bounds = bounds[filled.offset:filled.offset + rows + 1].astype(np.int64)
    held = filled.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, dtype=np.uint8)
    low = 0
    while low < rows:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1)
        yield low, high, data[bounds[low]:bounds[high]], bounds[low:high + 1] - bounds[low]
        low = high


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; a word never crosses rows."""
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    solid = ~SPACES[data]
    opens = np.zeros(n + 1, dtype=bool)
    opens[offsets] = True
    opens[n] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = solid[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = solid[1:]
    starts = np.flatnonzero(solid & (~before | opens[:-1]))
    ends = np.flatnonzero(solid & (~after | opens[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1
