"""Words of an Arrow column of texts as 64-bit hashes, computed on its bytes in bulk."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are handled in groups of about so many bytes, so the arrays below, some 70 bytes for each of them, stay small:
# every worker of an executor holds its own, and keeps what it once had for the stages after.
GROUP_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
#: Bytes that separate words: white space of ASCII.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def _power(name: str, base: np.uint64, size: int) -> np.ndarray:
    """Powers of ``base`` modulo 2^64, at least ``size`` of them."""
    held = _powers.get(name)
    if held is None or len(held) < size:
        factors = np.full(max(size, GROUP_BYTES + 1), base, np.uint64)
        factors[0] = 1
        held = np.multiply.accumulate(factors)
        _powers[name] = held
    return held[:size]


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def groups(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows in them and the end) of consecutive rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + GROUP_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, held[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


#: Bytes that separate words: ASCII other than letters and digits.
MARKS = np.ones(256, bool)
MARKS[48:58] = MARKS[65:91] = MARKS[97:123] = False
MARKS[128:] = False


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words start and end; no word goes on from one row into the next."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~gap[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    return np.flatnonzero(inside & (~before | fresh[:-1])), np.flatnonzero(inside & (~after | fresh[1:])) + 1


class Slices:
    """Hashes of any slices of some bytes, from running sums of their lower-cased values."""

    def __init__(self, data: np.ndarray):
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((LOWERED[data].astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, len(data)), out=self.total[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray, kind: int = 0) -> np.ndarray:
        sums = (self.total[ends] - self.total[starts]) * _power("down", _INVERSE, len(self.total))[starts]
        return mixed(sums + ((ends - starts) + 1000 * kind).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE):
    """(hash of each lower-cased word, number of words before each row and in all) for rows of bytes."""
    starts, ends = word_spans(data, offsets, gap)
    return Slices(data).hashes(starts, ends), np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int, short: bool = True):
    """
    (hash of each run of ``size`` words within a row, its bounds by row); repeats included.

    With ``short``, a row of fewer words, but not none, has them all as one run.
    """
    counts = np.diff(bounds)
    runs = np.maximum(counts - size + 1, (counts > 0) if short else 0)
    edges = np.concatenate([[0], np.cumsum(runs)])
    row = np.repeat(np.arange(len(counts)), runs)
    starts = np.arange(edges[-1]) - edges[row] + bounds[row]
    ends = np.minimum(starts + size, bounds[row + 1])
    out = np.zeros(len(starts), np.uint64)
    for k in range(size):
        there = starts + k < ends
        word = words[np.minimum(starts + k, max(0, len(words) - 1))] if len(words) else np.zeros(0, np.uint64)
        out = np.where(there, mixed(out * np.uint64(0x9FB21C651E98DF25) + word + np.uint64(k + 1)), out)
    return out, edges
