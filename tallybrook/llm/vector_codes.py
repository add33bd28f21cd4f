"""
Vector codes by product quantisation, fitted with dual-tree Lloyd rounds.

1. Vectors, as whole numbers, are cut into ``PARTS`` equal parts. A task packs its rows into blocks of
   ``BLOCK``; for each part position a block holds a tree of boxes over its parts: the parts in the order
   of the tree, so that a node is a run of them. The blocks are written once; no row is shuffled.
2. In a round, the entries of a codebook get a tree as well, and both trees go down together. For a pair of
   nodes the boxes bound the distances between their members from below and above; a pair whose
   lower bound is over the best upper bound of its node of parts is dropped with all its descendants.
3. A node of parts with a single entry left is assigned as a whole, from sums of the block that are
   cached for each place. Leaves with several entries left compare whole numbers, exactly; ties go
   to the lower index.
4. Tasks add up sums and counts per entry; the new codebook is their floored quotient. The driver
   holds the codebooks and these sums only: ``PARTS`` times ``ENTRIES`` rows of a part's width.

A vector that is null or holds a null, NaN or infinity is dropped. Vectors of different lengths, or
whose length ``PARTS`` does not divide, are refused, and so are components too large for sums of
products in 64 bits. The first codebook takes rows by id (nulls last), then by vector; with fewer than ``ENTRIES``
rows it is shorter. Equal entries stay; parts go to the first of them. Rows equal in id and vector
count each. Null labels are one label. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.base import ship_package, spread_join, stored
from tallybrook.llm.vectors import BoxTree, exact, matrix, whole_vectors

PARTS, ENTRIES, ROUNDS = 4, 256, 4
BLOCK, LEAF = 2048, 64


class EntryTree:
    """A codebook for many searches: distinct entries, each at its first index, under boxes."""

    def __init__(self, entries: np.ndarray):
        _, first = np.unique(entries, axis=0, return_index=True)
        index = np.sort(first)
        tree = BoxTree(entries[index], 1, index)
        self.tree, self.index, self.points = tree, index[tree.order], entries[index][tree.order]


def nearest(points: np.ndarray, tree: BoxTree, entries: EntryTree) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """
    (entry of each of the ``points``, which are in the order of ``tree``; the runs (start, end, entry)
    that were assigned without looking at their points, for use with cached sums).
    """
    points, low, high, places, e_low, e_high = exact(
        points, tree.low, tree.high, entries.points, entries.tree.low, entries.tree.high)
    out, whole = np.full(len(points), -1, np.int64), []
    best = np.full(len(low), np.inf)
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(a):
        gap = np.maximum(np.maximum(low[a] - e_high[b], e_low[b] - high[a]), 0)
        span = np.maximum(np.abs(high[a] - e_low[b]), np.abs(e_high[b] - low[a]))
        near, far = (gap * gap).sum(1), (span * span).sum(1)
        np.minimum.at(best, a, far)
        keep = near <= best[a]
        a, b = a[keep], b[keep]
        if not len(a):
            break
        # Nodes of parts whose only entry is known, and leaves whose entry nodes are all leaves.
        nodes, row, count = np.unique(a, return_inverse=True, return_counts=True)
        b_leaf = entries.tree.left[b] < 0
        alone = (count[row] == 1) & b_leaf
        for node, entry in zip(a[alone].tolist(), entries.index[entries.tree.start[b[alone]]].tolist()):
            out[tree.start[node]:tree.end[node]] = entry
            whole.append((int(tree.start[node]), int(tree.end[node]), entry))
        open_ = np.zeros(len(nodes), bool)
        np.logical_or.at(open_, row, ~b_leaf)
        bottom = ~alone & (tree.left[a] < 0) & ~open_[row]
        order = np.argsort(a[bottom], kind="stable")
        held, their = a[bottom][order], entries.tree.start[b[bottom][order]]
        edges = np.flatnonzero(np.diff(held, prepend=-1, append=-1))
        for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):
            start, end = int(tree.start[held[first]]), int(tree.end[held[first]])
            own = np.sort(their[first:last])
            own = own[np.argsort(entries.index[own], kind="stable")]
            at = places[own]
            # Squared distances less the part's own square, which is the same for all entries.
            distance = (at * at).sum(1) - 2 * (points[start:end] @ at.T)
            out[start:end] = entries.index[own[distance.argmin(1)]]
        rest = ~alone & ~bottom
        a, b, b_leaf = a[rest], b[rest], b_leaf[rest]
        # The children of both; a leaf stands for itself.
        a_leaf = tree.left[a] < 0
        a2 = [np.where(a_leaf, a, tree.left[a]), tree.right[a]]
        for side, child in enumerate(a2):
            down = ~a_leaf if side else np.ones(len(a), bool)
            best[child[down]] = np.minimum(best[child[down]], best[a[down]])
        pairs = []
        for side_a, child_a in enumerate(a2):
            for side_b, child_b in enumerate((np.where(b_leaf, b, entries.tree.left[b]), entries.tree.right[b])):
                there = (~a_leaf if side_a else True) & (~b_leaf if side_b else np.ones(len(b), bool))
                pairs.append((child_a[there], child_b[there]))
        a, b = (np.concatenate(x) for x in zip(*pairs))
    return out, whole


def _blocks(size: int):
    """Rows packed into blocks: ids, labels, and for each part position the parts in the order of their tree."""
    def packed(held: list) -> pa.RecordBatch:
        ids, labels = (pa.concat_arrays([h[i] for h in held]) for i in (0, 1))
        points = np.concatenate([h[2] for h in held])
        orders, parts = [], []
        for own in np.split(points, PARTS, axis=1):
            order = BoxTree(own, LEAF).order
            orders.append(order.astype(np.int32).tobytes())
            parts.append(own[order].tobytes())
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.RecordBatch.from_arrays(
            [one(ids), one(labels), pa.array([points.shape[1]], pa.int32()),
             pa.array([orders], pa.list_(pa.binary())), pa.array([parts], pa.list_(pa.binary()))],
            ["ids", "labels", "width", "orders", "parts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, width = [], 0, None
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                column = part.column("v")
                lengths = np.unique(np.diff(column.offsets.to_numpy()))
                width = int(lengths[0]) if width is None else width
                if (lengths != width).any() or width % PARTS:
                    raise ValueError(f"vectors must all have one length that {PARTS} divides, not {sorted({width, *lengths.tolist()})}")
                held.append((part.column("vec_id"), part.column("label"), matrix(column, width)))
                rows += part.num_rows
                if rows >= size:
                    yield packed(held)
                    held, rows = [], 0
        if rows:
            yield packed(held)

    return run


def _read(batch: pa.RecordBatch):
    """(row in the batch, part position, order, parts in order) of each tree of the batch."""
    for k in range(batch.num_rows):
        width = batch.column("width")[k].as_py() // PARTS
        for p, (order, parts) in enumerate(zip(batch.column("orders")[k].as_py(), batch.column("parts")[k].as_py())):
            order = np.frombuffer(order, np.int32)
            yield k, p, order, np.frombuffer(parts, np.int64).reshape(len(order), width)


class _Runs(BoxTree):
    """The tree of parts that already are in its order; its nodes are the runs that halving gives."""

    def __init__(self, points: np.ndarray):
        starts, ends, left, right = [], [], [], []
        waiting = [(0, len(points), -1, left)]
        while waiting:
            start, end, parent, side = waiting.pop()
            node = len(starts)
            if parent >= 0:
                side[parent] = node
            for held, value in ((starts, start), (ends, end), (left, -1), (right, -1)):
                held.append(value)
            if end - start > LEAF:
                middle = (end - start) // 2
                waiting += [(start + middle, end, node, right), (start, start + middle, node, left)]
        self.start, self.end, self.left, self.right = (np.array(x) for x in (starts, ends, left, right))
        self.low = np.array([points[a:b].min(0) for a, b in zip(starts, ends)])
        self.high = np.array([points[a:b].max(0) for a, b in zip(starts, ends)])


def _sums(codebooks: list[np.ndarray]):
    """Sums of the parts nearest to each entry, with their number at the end, once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [EntryTree(c) for c in codebooks]
        sums = [np.zeros(c.shape, np.int64) for c in codebooks]
        counts = [np.zeros(len(c), np.int64) for c in codebooks]
        for batch in batches:
            for _, p, _, points in _read(batch):
                code, whole = nearest(points, _Runs(points), trees[p])
                cached = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points, axis=0)])
                alone = np.ones(len(points), bool)
                for start, end, entry in whole:
                    sums[p][entry] += cached[end] - cached[start]
                    counts[p][entry] += end - start
                    alone[start:end] = False
                np.add.at(sums[p], code[alone], points[alone])
                np.add.at(counts[p], code[alone], 1)
        for p, own in enumerate(counts):
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p), pa.int32()), pa.array(used, pa.int32()),
                 pa.array(list(np.column_stack([sums[p][used], own[used]])), pa.list_(pa.int64()))], ["part", "entry", "sums"])

    return run


def _codes(codebooks: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [EntryTree(c) for c in codebooks if len(c)]
        for batch in batches:
            codes: dict[int, np.ndarray] = {}
            errors: dict[int, np.ndarray] = {}
            for k, p, order, points in _read(batch):
                code, _ = nearest(points, _Runs(points), trees[p])
                own = codes.setdefault(k, np.zeros((len(order), PARTS), np.uint8))
                own[order, p] = code
                off = points - codebooks[p][code]
                errors.setdefault(k, np.zeros(len(order), np.int64))[order] += (off * off).sum(1)
            for k, own in codes.items():
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[k].values, batch.column("labels")[k].values,
                     pa.array([row.tobytes().hex() for row in own], pa.string()), pa.array(errors[k])],
                    ["vec_id", "label", "code", "error"])

    return run


def fit(blocks: DataFrame, codebooks: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after ``rounds`` of assigning every part and moving every used entry to its floored mean."""
    for _ in range(rounds):
        found = blocks.mapInArrow(_sums(codebooks), "part int, entry int, sums array<long>")
        sums = found.select("part", "entry", F.posexplode("sums").alias("pos", "sum")).groupBy("part", "entry", "pos").agg(
            F.sum("sum").alias("sum")).groupBy("part", "entry").agg(F.sort_array(F.collect_list(F.struct("pos", "sum"))).alias("sums"))
        codebooks = [c.copy() for c in codebooks]
        for row in sums.collect():
            *total, n = (s["sum"] for s in row.sums)
            codebooks[row.part][row.entry] = [x // n for x in total]
    return codebooks


def codes(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """``vec_id, label, code, error`` of every kept row of ``vectors(vec_id, embedding, label)``, and the codebooks' digest."""
    if not 0 < entries <= ENTRIES:
        raise ValueError(f"a codebook has 1 to {ENTRIES} entries, not {entries}")
    ship_package(vectors.sparkSession)
    fit_, whole = whole_vectors(vectors)
    kept = vectors.filter(fit_).select("vec_id", "label", whole.alias("v"))
    first = kept.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    id_, label = (kept.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    blocks = stored(kept.mapInArrow(_blocks(block), f"ids array<{id_}>, labels array<{label}>, width int, "
                                    "orders array<binary>, parts array<binary>"), "blocks")
    books = [np.zeros((0, 0), np.int64)] * PARTS
    if first:
        books = fit(blocks, np.split(np.array([r.v for r in first], np.int64).reshape(len(first), -1), PARTS, axis=1), rounds)
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    return blocks.mapInArrow(_codes(books), f"vec_id {id_}, label {label}, code string, error long").withColumn(
        "codebooks_sha256", F.lit(digest))


def report(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    rows = stored(codes(vectors, entries, rounds, block), "codes")
    totals = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    return spread_join(rows, totals, "label").select("vec_id", "code", "error", "label_error", "codebooks_sha256")
