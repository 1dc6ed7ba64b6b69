"""Vectorised text primitives over Arrow string buffers, shared by the Python operators.

Words are maximal runs of bytes outside ``\\x20\\x09-\\x0D``; a null text is empty.
All hashes are 64-bit, position independent and the same on every machine.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240611))
#: A random 64-bit value for each byte, and odd multipliers with their inverses modulo 2**64.
BYTE_VALUES = [_RNG.integers(1, 2**64, 256, dtype=U64) for _ in range(2)]
BASES = [int(x) | 1 for x in _RNG.integers(2**40, 2**64, 2, dtype=U64)]
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
#: What a worker keeps between the tasks of one operator; tasks of another one forget it.
KEPT: list = []


def release() -> None:
    """Gives memory that is free back to the machine: Python workers live on, beside an executor's heap, between tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def forget() -> None:
    """Drops what the tasks of other operators have left in this worker."""
    KEPT.clear()
    _POWERS.clear()


def powers(which: int, n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of base ``which`` (or of its inverse) modulo 2**64."""
    have = _POWERS.get((which, inverse))
    if have is None or len(have) < n:
        base = pow(BASES[which], -1, 2**64) if inverse else BASES[which]
        have = np.full(max(n, 1 << 16), base, dtype=U64)
        have[0] = 1
        np.cumprod(have, out=have)
        _POWERS[which, inverse] = have
    return have[:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective finaliser, so that near inputs have unrelated outputs."""
    x = x + U64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class SpanHasher:
    """Hashes of any spans of a sequence of 64-bit values, in constant time for each span."""

    def __init__(self, values: np.ndarray, which: int = 0):
        n = len(values)
        self.which = which
        self.sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(values * powers(which, n), out=self.sums[1:])
        self.inverse = powers(which, n + 1, inverse=True)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(raw + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93), self.which)


def byte_hasher(data: np.ndarray, which: int = 0) -> SpanHasher:
    return SpanHasher(BYTE_VALUES[which][data], which)


def slices(column: pa.Array, max_bytes: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows of about ``max_bytes``; a longer text stands alone."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    _, offsets, values = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + max_bytes, side="right")) - 1)
        yield row, end, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end
    release()


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start bytes, end bytes, bounds): words of text i are bounds[i]:bounds[i + 1]."""
    word = ~IS_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | first[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    return byte_hasher(data, which)(starts, ends)


def windows(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first items, their text) of all runs of ``size`` items that stay in one text."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(bounds[:-1], counts), text


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """A flag for each of n items: whether it is in a run of ``size`` items from one of ``starts``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, n), -1)
    return np.cumsum(edge[:-1]) > 0


def rolling(values: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hashes of all runs of ``size`` values, as :class:`SpanHasher` gives them, across the edges of texts too."""
    n = len(values)
    if n < size:
        return np.zeros(0, dtype=U64)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(values * powers(which, n), out=sums[1:])
    raw = (sums[size:] - sums[:-size]) * powers(which, n - size + 1, inverse=True)
    return mix(raw + U64(size * 0xD6E8FEB86659FD93 % 2**64), which)


def running_least(keys: np.ndarray, window: int) -> np.ndarray:
    """The least key of each run of ``window``: from minima within blocks, forward and backward."""
    n = len(keys)
    if n < window:
        return keys[:0]
    padded = np.full(-(-n // window) * window, np.iinfo(keys.dtype).max, dtype=keys.dtype)
    padded[:n] = keys
    blocks = padded.reshape(-1, window)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - window + 1], forward[window - 1 : n])


PLACE_BITS = 24


def minimizers(hashes: np.ndarray, bounds: np.ndarray, size: int, length: int) -> np.ndarray:
    """Sorted places of the anchors of all runs of ``length`` items that stay in one text (``bounds``).

    ``hashes`` are those of the runs of ``size`` items, from each place on. A run's anchor is the least of them inside it,
    the first of equals, so that equal runs have equal anchors at equal places. Hashes are compared by their upper
    40 bits; among equals of those the first is taken.
    """
    places = U64(2**PLACE_BITS - 1)
    keys = (hashes & ~places) | (np.arange(len(hashes), dtype=U64) & places)
    least = running_least(keys, length - size + 1)
    counts = np.diff(bounds)
    full = counts >= length
    edge = np.zeros(len(least) + 1, dtype=np.int8)
    # starts of texts and ends of their runs are distinct places, each of one text
    edge[bounds[:-1][full]] += 1
    edge[bounds[:-1][full] + counts[full] - length + 1] -= 1
    at = np.flatnonzero(np.cumsum(edge[:-1], dtype=np.int8))
    picked = least[at]
    new = np.ones(len(picked), dtype=bool)
    new[1:] = picked[1:] != picked[:-1]
    at, low = at[new], (picked[new] & places).astype(np.int64)
    # a place is known by its lower bits, as it is less than length away from the run's start
    return np.unique(at + ((low - at) & (2**PLACE_BITS - 1)))
