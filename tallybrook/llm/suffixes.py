"""An enhanced suffix array over many short byte strings, and its tree of common-prefix intervals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

DIVERSE = -2


class SuffixArray:
    """
    The suffixes of some strings that are at least ``least`` bytes long, in order, with the length
    of the prefix each has in common with the one before it.

    Built by prefix doubling from 8 bytes on. Strings are parts of UTF-8 texts, in which no byte is
    255, so bytes are held one up and strings padded with zeros; common prefixes are cut at the
    end of the shorter suffix.
    """

    def __init__(self, strings: list[bytes], least: int):
        sizes = np.array([len(s) for s in strings], np.int64)
        longest = int(sizes.max(initial=0))
        self.pad = 1 << max(3, (longest - 1).bit_length())
        stride = longest + self.pad
        held = np.zeros((len(strings), stride), np.uint8)
        for k, s in enumerate(strings):
            held[k, :len(s)] = np.frombuffer(s, np.uint8) + np.uint8(1)
        counts = np.maximum(0, sizes - least + 1)
        self.string = np.repeat(np.arange(len(strings)), counts)
        self.offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        self.left = sizes[self.string] - self.offset
        flat, width = held.ravel(), max(1, longest)
        # Ranks of all places by their first 8, 16, 32, ... bytes.
        packed = np.zeros((len(strings), width), np.uint64)
        for k in range(8):
            packed = (packed << np.uint64(8)) | held[:, k:k + width]
        ranks, size = [np.unique(packed.ravel(), return_inverse=True)[1].reshape(packed.shape)], 8
        while 2 * size <= longest:
            last = ranks[-1]
            shifted = np.zeros_like(last)
            if size < width:
                shifted[:, :width - size] = last[:, size:] + 1
            ranks.append(np.unique(last * (int(last.max()) + 2) + shifted, return_inverse=True)[1].reshape(last.shape))
            size *= 2
        # The last step, up to twice that length, is taken for the suffixes only.
        last, further = ranks[-1], self.offset + size
        rest = np.where(further < width, last[self.string, np.minimum(further, width - 1)] + 1, 0)
        order = np.argsort(last[self.string, self.offset] * (int(last.max(initial=0)) + 2) + rest, kind="stable")
        self.string, self.offset, self.left = self.string[order], self.offset[order], self.left[order]
        self.common = np.zeros(len(order), np.int64)
        if len(order) > 1:
            a, b = self.string[:-1], self.string[1:]
            at, other, same = self.offset[:-1].copy(), self.offset[1:].copy(), np.zeros(len(a), np.int64)
            for rank in ranks[::-1]:
                fits = (at < width) & (other < width)
                equal = fits & (rank[a, np.minimum(at, width - 1)] == rank[b, np.minimum(other, width - 1)])
                step = np.where(equal, size, 0)
                at, other, same = at + step, other + step, same + step
                size //= 2
            for _ in range(7):
                equal = flat[a * stride + np.minimum(at, stride - 1)] == flat[b * stride + np.minimum(other, stride - 1)]
                going = equal & (same == at - self.offset[:-1])
                at, other, same = at + going, other + going, same + going
            self.common[1:] = np.minimum(same, np.minimum(self.left[:-1], self.left[1:]))
        #: The byte before each suffix; DIVERSE where its string begins with it.
        self.before = np.where(self.offset > 0, flat[self.string * stride + np.maximum(self.offset - 1, 0)].astype(np.int64), DIVERSE)


def _steps(common: np.ndarray, least: int) -> list[int]:
    """The places where an interval of ``least`` or more goes on or ends."""
    deep = np.concatenate([common >= least, [False]])
    return (np.flatnonzero(deep[1:] | deep[:-1]) + 1).tolist() if len(common) else []


def intervals(array: SuffixArray, least: int) -> Iterator[tuple[int, int, int, bool]]:
    """
    (depth, first, last, diverse) of every interval of suffixes with ``least`` bytes or more in
    common, inner ones first: a scan with a stack of the open intervals. ``diverse`` says that the
    bytes before the suffixes differ, so the repeat can't be extended to the left.
    """
    common, before = array.common.tolist(), array.before.tolist()
    stack: list[list[int]] = []
    for k in _steps(array.common, least):
        depth = common[k] if k < len(common) else 0
        first, mark = k - 1, before[k - 1]
        if depth < least:
            depth = 0
        while stack and stack[-1][0] > depth:
            top = stack.pop()
            top[2] = top[2] if top[2] == mark else DIVERSE
            yield top[0], top[1], k - 1, top[2] == DIVERSE
            first, mark = top[1], top[2]
        if depth >= least:
            if stack and stack[-1][0] == depth:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == mark else DIVERSE
            else:
                stack.append([depth, first, mark])


def maximal_repeats(strings: list[bytes], least: int) -> list[tuple[bytes, list[tuple[int, int]]]]:
    """Every repeat of ``least`` bytes or more that can't be extended, with all places (string, offset)."""
    array, out = SuffixArray(strings, least), []
    for depth, first, last, diverse in intervals(array, least):
        if diverse:
            places = sorted(zip(array.string[first:last + 1].tolist(), array.offset[first:last + 1].tolist()))
            out.append((strings[places[0][0]][places[0][1]:places[0][1] + depth], places))
    return out


def repeated_lengths(array: SuffixArray, least: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """
    (suffixes, lengths): how long a prefix of each suffix also starts at an earlier ``place``,
    for the left-diverse repeats; every repeated byte is in one of these prefixes.

    Goes through the intervals with the earliest suffix of each: one that is not the earliest of
    an interval has that interval's depth, its deepest, as it is passed on no further.
    """
    common, before, places = array.common.tolist(), array.before.tolist(), place.tolist()
    found, lengths = [], []
    stack: list[list] = []  # depth, byte before, earliest suffix, the others

    def meet(top, other):
        """The earlier one stays; of one place given twice, neither repeats the other."""
        if places[other] < places[top[2]]:
            top[3].append(top[2])
            top[2] = other
        elif places[other] > places[top[2]]:
            top[3].append(other)

    for k in _steps(array.common, least):
        depth = common[k] if k < len(common) else 0
        mark, best = before[k - 1], k - 1
        if depth < least:
            depth = 0
        while stack and stack[-1][0] > depth:
            top = stack.pop()
            if top[1] != mark:
                top[1] = DIVERSE
            meet(top, best)
            if top[1] == DIVERSE:
                found += top[3]
                lengths += [top[0]] * len(top[3])
            mark, best = top[1], top[2]
        if depth >= least:
            if stack and stack[-1][0] == depth:
                top = stack[-1]
                if top[1] != mark:
                    top[1] = DIVERSE
                meet(top, best)
            else:
                stack.append([depth, mark, best, []])
    return np.array(found, np.int64), np.array(lengths, np.int64)
