"""Vectors as whole numbers, and the trees of boxes that searches over them go through."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1024
#: Sums of products up to here are exact in doubles, and up to there in 64 bits.
EXACT, LARGEST = 1 << 53, 1 << 62


def whole_vectors(df: DataFrame, column: str = "embedding") -> tuple[Column, Column]:
    """(condition that a vector takes part, its components as floor(SCALE * x)) for a column of ``df``."""
    vector = df[column]
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & finite, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column whose lists all have ``width`` elements."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), width)


def exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as doubles where sums of products of any two rows are exact in them, else as 64-bit integers."""
    most = max((int(max(a.max(), -a.min())) for a in arrays if a.size), default=0)
    products = 4 * max(a.shape[-1] for a in arrays) * (most + 1) ** 2
    if products >= LARGEST:
        raise ValueError(f"components up to {most} are too large for sums of products in 64 bits")
    return [a.astype(np.float64 if products < EXACT else np.int64) for a in arrays]


class BoxTree:
    """
    Points split at medians of their widest side, down to ``leaf`` points; tight boxes round each node.

    ``order`` has the points in the order of the tree, so a node is a run ``start:end`` of it. Nodes
    are numbered parents first; a leaf has no children (-1). Among equal points the lower of ``rank`` come first.
    """

    def __init__(self, points: np.ndarray, leaf: int, rank: np.ndarray | None = None):
        order = np.arange(len(points)) if rank is None else np.argsort(rank, kind="stable")
        starts, ends, lows, highs, left, right = [], [], [], [], [], []
        waiting = [(0, len(points), -1, left)]
        while waiting:
            start, end, parent, side = waiting.pop()
            own = points[order[start:end]]
            low, high = own.min(0), own.max(0)
            node = len(starts)
            if parent >= 0:
                side[parent] = node
            for held, value in ((starts, start), (ends, end), (lows, low), (highs, high), (left, -1), (right, -1)):
                held.append(value)
            if end - start > leaf:
                middle = (end - start) // 2
                if len(low) and (wide := high - low).max() > 0:
                    order[start:end] = order[start:end][np.argsort(own[:, wide.argmax()], kind="stable")]
                waiting += [(start + middle, end, node, right), (start, start + middle, node, left)]
        self.order = order
        self.start, self.end = np.array(starts), np.array(ends)
        self.left, self.right = np.array(left), np.array(right)
        self.low, self.high = np.array(lows), np.array(highs)
