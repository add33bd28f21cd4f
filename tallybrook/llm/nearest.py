"""
Exact top-k by inner product, with a KD-tree per shard.

1. The vectors, as whole numbers, are written with a row number. A sample of about ``SAMPLE`` rows
   is split at medians of its widest side into at most ``CELLS`` cells; every row goes down these
   splits to its cell. A cell with more than ``ROWS`` rows (equal vectors can't be split) is dealt
   into parts by row number, so each shard (cell and part) has about ``ROWS`` rows at most, at any skew.
2. Each query first searches the sample, in a tree of its own: the ``k``-th best there is a bound that
   is propagated to the shards. It is sent to the shards of those cells only whose box can hold a score
   that the bound does not beat.
3. In a shard, a tree is built by median splits down to ``LEAF`` rows, with tight boxes. Each query
   goes through it best-first: the node of the best bound between box and query next, until none can
   beat the ``k``-th best found so far, or the propagated one. Equal bounds are told apart by the
   smallest id in the node, so that many equal vectors are not gone through either.
4. The at most ``k`` results of each shard are ranked per query.

Rows of a shard and its queries are sorted into one stream, so a task holds a tree and a batch of
queries; nothing else grows. The driver holds the sample, the splits and the cells' boxes.

A vector that is null or holds a null, NaN or infinity takes no part. Vectors of different lengths
never meet; empty ones do, with score 0. Rows are told apart by their number: rows equal in id and
vector are candidates of each other, and each is a query. A row with a null id is a candidate, ranked
after all others of its score, and no query. Ties go to the smaller id. An empty table gives no rows.
Components too large for a sum of products in 64 bits are refused. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.base import partitions, ship_package, stored
from tallybrook.llm.vectors import BoxTree, exact, matrix, whole_vectors

ROWS, LEAF, SAMPLE, CELLS = 8192, 256, 8192, 1024
LAST = (1 << 63) - 1
NOTHING = (-(1 << 63), LAST)


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(length, rows) of the vectors of each length."""
    lengths = np.diff(column.offsets.to_numpy())
    for length in np.unique(lengths):
        yield int(length), np.flatnonzero(lengths == length)


class Cells:
    """Median splits of a sample, as far down as cells of ``rows`` rows of the whole table need."""

    def __init__(self, points: np.ndarray, total: int, rows: int, cells: int):
        self.axis, self.cut, self.children = [], [], []
        depth = max(0, min(total // max(1, rows), cells)).bit_length()
        self._split(points, depth)

    def _split(self, points: np.ndarray, depth: int) -> int:
        node = len(self.axis)
        self.axis.append(-1)
        self.cut.append(0)
        self.children.append((-1, -1))
        if depth > 0 and len(points) > 1 and points.shape[1]:
            axis = int((points.max(0) - points.min(0)).argmax())
            cut = int(np.sort(points[:, axis])[(len(points) - 1) // 2])
            below = points[:, axis] <= cut
            if not below.all():
                self.axis[node], self.cut[node] = axis, cut
                self.children[node] = (self._split(points[below], depth - 1), self._split(points[~below], depth - 1))
        return node

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            if self.axis[node] < 0:
                out[rows] = node
            elif len(rows):
                below = points[rows, self.axis[node]] <= self.cut[node]
                waiting += [(self.children[node][0], rows[below]), (self.children[node][1], rows[~below])]
        return out


class Shard:
    """A tree over some rows, searched for the ``k`` best inner products with a query."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        self.tree = BoxTree(points, LEAF, ids)
        order = self.tree.order
        self.points, self.ids, self.rows = points[order], ids[order], rows[order]
        self.least = [int(self.ids[a:b].min()) for a, b in zip(self.tree.start, self.tree.end)]

    def search(self, queries: np.ndarray, own: np.ndarray, bounds: list[tuple[int, int]], k: int):
        """(position in the shard, score) of the best rows for each query, none worse than its bound (score, id)."""
        points, low, high, queries = exact(self.points, self.tree.low, self.tree.high, queries)
        # The largest product of any vector in a node's box with a query.
        reach = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
        left, right, start, end = (x.tolist() for x in (self.tree.left, self.tree.right, self.tree.start, self.tree.end))
        for query, row, bound, most in zip(queries, own.tolist(), bounds, reach.tolist()):
            places, scores = np.zeros(0, np.int64), np.zeros(0, points.dtype)
            kth, kth_id = bound
            waiting = [(-most[0], self.least[0], 0)]
            while waiting:
                best, least, node = heapq.heappop(waiting)
                # Worse nodes follow, and of equal ones those with larger ids.
                if -best < kth or (-best == kth and least > kth_id):
                    break
                if left[node] >= 0:
                    for child in (left[node], right[node]):
                        heapq.heappush(waiting, (-most[child], self.least[child], child))
                    continue
                a, b = start[node], end[node]
                found = points[a:b] @ query
                near = np.flatnonzero((found >= kth) & (self.rows[a:b] != row))
                if not len(near):
                    continue
                places, scores = np.concatenate([places, near + a]), np.concatenate([scores, found[near]])
                if len(places) >= k:
                    first = np.lexsort((self.ids[places], -scores))[:k]
                    places, scores = places[first], scores[first]
                    if (int(scores[-1]), -int(self.ids[places[-1]])) > (kth, -kth_id):
                        kth, kth_id = int(scores[-1]), int(self.ids[places[-1]])
            good = (scores > kth) | ((scores == kth) & (self.ids[places] <= kth_id))
            yield places[good], scores[good].astype(np.int64)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _boxes(cells: dict[int, Cells]):
    """Rows and box of each cell among a task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            column = batch.column("v")
            for length, rows in _by_length(column):
                points = matrix(column.take(pa.array(rows)), length)
                at = cells[length].of(points) if length in cells else np.zeros(len(rows), np.int32)
                for cell in np.unique(at):
                    own = points[at == cell]
                    n, low, high = held.get((length, int(cell)), (0, own[0], own[0]))
                    held[length, int(cell)] = n + len(own), np.minimum(low, own.min(0)), np.maximum(high, own.max(0))
        if held:
            keys, values = list(held), list(held.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([v[0] for v in values], pa.int64()), pa.array([v[1].tolist() for v in values], pa.list_(pa.int64())),
                 pa.array([v[2].tolist() for v in values], pa.list_(pa.int64()))], ["length", "cell", "n", "low", "high"])

    return run


ROUTED = "length int, cell int, part int, asks boolean, row long, vec_id long, v array<long>, kth long, kth_id long"
RESULTS = "row long, query_id long, vec_id long, score long"


def _routed(length, cell, part, asks, row, ids, v, kth, kth_id) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(row), length, np.int32)), pa.array(cell, pa.int32()), pa.array(part, pa.int32()),
         pa.array(np.full(len(row), asks)), row, ids, v, pa.array(kth, pa.int64()), pa.array(kth_id, pa.int64())],
        [c.split()[0] for c in ROUTED.split(", ")])


def _points(cells: dict[int, Cells], parts: dict):
    """Each row for the shard it lies in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, rows in _by_length(batch.column("v")):
                own = batch.take(pa.array(rows))
                at = cells[length].of(matrix(own.column("v"), length)) if length in cells else np.zeros(len(rows), np.int32)
                count = np.array([parts[length, int(c)] for c in at])
                none = np.zeros(len(rows), np.int64)
                yield _routed(length, at, own.column("row").to_numpy() % count, False,
                              own.column("row"), own.column("vec_id"), own.column("v"), none, none)

    return run


def _queries(sample: dict[int, tuple], boxes: dict[int, tuple], k: int):
    """Each query for every shard that may hold a result, with the k-th best of the sample as its bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = {length: Shard(*held) for length, held in sample.items()}
        for batch in batches:
            for length, rows in _by_length(batch.column("v")):
                own = batch.take(pa.array(rows))
                points, row = matrix(own.column("v"), length), own.column("row").to_numpy()
                bounds = [NOTHING] * len(rows)
                if length in shards:
                    shard = shards[length]
                    for q, (places, scores) in enumerate(shard.search(points, row, bounds, k)):
                        if len(places) == k:
                            bounds[q] = int(scores[-1]), int(shard.ids[places[-1]])
                cell, part, low, high = boxes[length]
                low, high, asked = exact(low, high, points)
                reach = np.maximum(asked, 0) @ high.T + np.minimum(asked, 0) @ low.T
                kth = np.array([b[0] for b in bounds])
                for first in range(0, len(rows), 256):
                    q, c = np.nonzero(reach[first:first + 256] >= kth[first:first + 256, None])
                    q += first
                    # A cell's parts are shards of their own.
                    to = np.repeat(np.arange(len(c)), part[c])
                    which = np.arange(len(to)) - np.repeat(np.cumsum(part[c]) - part[c], part[c])
                    at = pa.array(q[to])
                    yield _routed(length, cell[c[to]], which, True, own.column("row").take(at), own.column("vec_id").take(at),
                                  own.column("v").take(at), kth[q[to]], np.array([b[1] for b in bounds])[q[to]])

    return run


def _search(k: int):
    """The results of each shard, whose rows come before its queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, shard = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "cell", "part", "asks")])
            edges = np.flatnonzero(np.any(keys[:, 1:] != keys[:, :-1], axis=0)) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                if a == b:
                    continue
                length, cell, part, asks = (int(x) for x in keys[:, a])
                run_ = batch.slice(a, b - a)
                if (length, cell, part) != at:
                    at, held, shard = (length, cell, part), [], None
                points, rows, ids = matrix(run_.column("v"), length), run_.column("row").to_numpy(), run_.column("vec_id")
                if not asks:
                    held.append((points, _ids(ids), rows, ids))
                    continue
                if shard is None:
                    shard = Shard(*(np.concatenate([h[i] for h in held]) for i in range(3)))
                    given = pa.concat_arrays([h[3] for h in held]).take(pa.array(shard.tree.order))
                    held = []
                bounds = list(zip(run_.column("kth").to_pylist(), run_.column("kth_id").to_pylist()))
                found = list(shard.search(points, rows, bounds, k))
                counts = np.array([len(p) for p, _ in found])
                from_ = pa.array(np.repeat(np.arange(len(found)), counts))
                places = pa.array(np.concatenate([p for p, _ in found]))
                yield pa.RecordBatch.from_arrays(
                    [run_.column("row").take(from_), ids.take(from_), given.take(places),
                     pa.array(np.concatenate([s for _, s in found]), pa.int64())], ["row", "query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, rows: int = ROWS, sample: int = SAMPLE, cells: int = CELLS) -> DataFrame:
    """
    ``query_id, rank, vec_id, score``: the ``k`` best of ``vectors(vec_id, embedding)`` for each of
    its rows whose id is divisible by ``every``.

    ``rows`` are aimed at per shard, ``sample`` taken to the driver, which splits at most ``cells`` cells.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    fit, whole = whole_vectors(vectors)
    held = stored(vectors.filter(fit).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")).withColumn(
        "row", F.monotonically_increasing_id()), "vectors")
    total = held.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    drawn = held.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, sample / total))).limit(2 * sample)
    drawn = drawn.toArrow().combine_chunks().to_batches()
    samples = {}
    for batch in drawn:
        for length, at in _by_length(batch.column("v")):
            own = batch.take(pa.array(at))
            samples[length] = matrix(own.column("v"), length), _ids(own.column("vec_id")), own.column("row").to_numpy()
    split = {length: Cells(points, total * len(points) // max(1, sum(len(s[0]) for s in samples.values())), rows, cells)
             for length, (points, _, _) in samples.items()}
    found = held.mapInArrow(_boxes(split), "length int, cell int, n long, low array<long>, high array<long>")
    sides = found.select("length", "cell", F.posexplode(F.arrays_zip("low", "high")).alias("pos", "side"))
    sides = sides.groupBy("length", "cell", "pos").agg(F.min("side.low").alias("low"), F.max("side.high").alias("high"))
    sides = sides.groupBy("length", "cell").agg(F.sort_array(F.collect_list(F.struct("pos", "low", "high"))).alias("sides"))
    counts = found.groupBy("length", "cell").agg(F.sum("n").alias("n"))
    by_length = defaultdict(list)
    for c in counts.join(sides, ["length", "cell"], "left").collect():
        by_length[c.length].append((c.cell, -(-c.n // rows), [s.low for s in c.sides or ()], [s.high for s in c.sides or ()]))
    parts = {(length, cell): n for length, own in by_length.items() for cell, n, _, _ in own}
    boxes = {length: (np.array([c[0] for c in own]), np.array([c[1] for c in own]),
                      *(np.array([c[i] for c in own], np.int64).reshape(len(own), length) for i in (2, 3)))
             for length, own in by_length.items()}
    queries = held.filter(F.pmod("vec_id", F.lit(every)) == 0).mapInArrow(_queries(samples, boxes, k), ROUTED)
    routed = held.mapInArrow(_points(split, parts), ROUTED).unionByName(queries)
    key = ["length", "cell", "part"]
    tasks = max(partitions(spark), -(-sum(parts.values()) // 4))
    results = routed.repartition(tasks, *key).sortWithinPartitions(*key, "asks").mapInArrow(_search(k), RESULTS)
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return results.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
