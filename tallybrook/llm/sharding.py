"""
Shards by best-fit-decreasing packing of indivisible groups.

Documents with equal texts form a group (so do all null texts). Groups in order of falling
size enter the bin with the least room that still takes them; a new bin opens when none does.
The bins are kept in a balanced tree by remaining room.

The packing runs on the histogram of group sizes, not on the groups: groups of one size that
enter one after the other fill the tightest bin as often as it takes them, then the next, so a
run of equal sizes is placed at once, with the result it would have one by one. Sizes are
rounded up to 16 significant bits first, which bounds the histogram by about a million entries
at any corpus size and lets no bin overflow. The histogram is all that reaches the driver;
groups learn their bin from their rank within their size, and rows their place in the shard,
from counts per hash bucket, so neither a frequent size nor a full shard is in one task; nor is a
frequent text, as its rows get their shard by broadcast and are ranked by their numbers.

Null texts count 1 byte (their CRC is that of no bytes). An empty table gives no rows. Null
and repeated ids are rows like any other. Other columns are not read.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.base import partitions, spread_join, stored

SHARDS = 16


class RoomTree:
    """Bins by (room, bin) in a treap: a search tree kept balanced by random priorities."""

    def __init__(self):
        self.root, self.random = None, random.Random(0)

    def insert(self, room: int, bin_: int) -> None:
        low, high = self._split(self.root, (room, bin_))
        self.root = self._merge(self._merge(low, [(room, bin_), self.random.random(), None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least room of at least ``size``."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        parent, node = None, high
        while node[2] is not None:
            parent, node = node, node[2]
        if parent is None:
            high = node[3]
        else:
            parent[2] = node[3]
        self.root = self._merge(low, high)
        return node[0]

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = self._split(node[3], key)
            return node, high
        low, node[2] = self._split(node[2], key)
        return low, node

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] < high[1]:
            low[3] = self._merge(low[3], high)
            return low
        high[2] = self._merge(low, high[2])
        return high


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int]]:
    """
    Pack ``count`` groups of each size into bins of ``capacity``: runs (size, first, count, bin)
    with ``first`` the rank of the run's first group among those of its size. A group larger
    than the capacity gets a bin of its own.
    """
    tree, runs, bins = RoomTree(), [], 0
    for size, count in sorted(sizes, reverse=True):
        first = 0
        while first < count:
            if found := tree.take_tightest(size):
                room, bin_ = found
            else:
                room, bin_, bins = max(capacity, size), bins, bins + 1
            fit = min(count - first, room // size)
            runs.append((size, first, fit, bin_))
            first += fit
            tree.insert(room - fit * size, bin_)
    return runs


def equal_shards(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """
    Runs of the packing into at most ``shards`` bins with the smallest capacity found.

    Groups larger than an even share of the rest have a bin to themselves; the others are packed
    by best-fit-decreasing, the capacity narrowed between the even share and twice that.
    """
    left = sorted((s for s in sizes if s[1] > 0), reverse=True)
    own: list[tuple[int, int, int, int]] = []
    total, free = sum(s * n for s, n in left), shards
    while left and free > 1 and left[0][0] * free >= total:
        size, count = left[0]
        own.append((size, sum(r[2] for r in own if r[0] == size), 1, len(own)))
        left[0:1] = [(size, count - 1)] if count > 1 else []
        total, free = total - size, free - 1
    if not left:
        return own
    low, high, best = max(-(-total // free), left[0][0]), 2 * max(-(-total // free), left[0][0]), None
    while best is None or high - low > low // 100_000:
        middle = (low + high) // 2 if best else high
        runs = best_fit_decreasing(left, middle)
        if max(r[3] for r in runs) < free:
            best, high = runs, middle
        elif best is None:
            low, high = high, 2 * high
        else:
            low = middle + 1
    taken = {size: sum(r[2] for r in own if r[0] == size) for size, *_ in own}
    return own + [(size, first + taken.get(size, 0), count, bin_ + len(own)) for size, first, count, bin_ in best]


def size_class(size: Column) -> Column:
    """The size rounded up to 16 significant bits."""
    step = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.floor(F.log2(size.cast("double"))).cast("int") - 15))
    return (F.ceil(size / step) * step).cast("long")


def ranked(df: DataFrame, keys: list[str], order: list[str], name: str, buckets: int) -> DataFrame:
    """
    ``df`` with ``name``: the row's place from 0 among the rows of its keys.

    Rows are ranked within hash buckets of ``order``; the counts of the buckets before are added.
    """
    cut = df.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(*keys, "__b").agg(F.count("*").alias("__n")).select(
        *(F.col(k).alias(f"__{k}") for k in keys), F.col("__b").alias("__bucket"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy(*keys, "__b").orderBy(*order)) - 1
    on = (F.col("__b") == F.col("__bucket"))
    for k in keys:
        on &= F.col(k) == F.col(f"__{k}")
    return cut.withColumn("__place", place).join(counts, on).withColumn(
        name, F.col("__before") + F.col("__place")).drop("__b", "__bucket", "__before", "__place", *(f"__{k}" for k in keys))


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs(doc_id, text)``."""
    spark: SparkSession = docs.sparkSession
    size = F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")) + 1
    rows = stored(docs.select(
        "doc_id", size.alias("size"), F.coalesce(F.crc32("text"), F.lit(0).cast("long")).alias("text_crc32"),
        F.coalesce(F.sha2("text", 256), F.lit("")).alias("text_sha"), F.monotonically_increasing_id().alias("row_number")), "shard-rows")
    groups = stored(rows.groupBy("text_sha").agg(F.sum("size").alias("total")).withColumn(
        "class", size_class(F.col("total"))), "shard-groups")
    sizes = [(r["class"], r["n"]) for r in groups.groupBy("class").agg(F.count("*").alias("n")).collect()]
    runs = list(accumulate_runs(equal_shards(sizes, shards)))
    table = spark.createDataFrame(runs, "run_class long, first long, upto long, shard int")
    buckets = 4 * partitions(spark)
    numbered = ranked(groups, ["class"], ["text_sha"], "rank", buckets)
    # The runs are bounded by the histogram, whose entries are bounded by the rounding.
    placed = numbered.join(F.broadcast(table), (F.col("class") == F.col("run_class")) & (
        F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("upto"))).select(
            "text_sha", "shard")
    sharded = spread_join(rows, placed, "text_sha")
    return ranked(sharded, ["shard"], ["row_number"], "slot", buckets).select(
        "doc_id", "size", "text_crc32", "shard", "slot")


def accumulate_runs(runs):
    """Runs as (size, first, first beyond, bin)."""
    return ((size, first, first + count, bin_) for size, first, count, bin_ in runs)


def report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    return assign(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
