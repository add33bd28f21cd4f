"""
Near duplicates by MinHash with tensored banding.

A document is its set of distinct shingles. Two collections of ``TABLES`` half keys are
computed, each half key from ``ROWS`` minimum hashes; the key of a table is a pair of one half
key from either collection. ``2 * TABLES * ROWS`` minimum hashes so serve ``TABLES ** 2`` tables
of ``2 * ROWS`` rows, where plain banding would need ``2 * ROWS * TABLES ** 2`` of them. Two
documents of similarity s miss each other with a probability below 2 * (1 - s^ROWS)^TABLES:
2e-5 at 0.8, 1e-7 at 0.85.

1. Documents with equal sets are one node from the start.
2. A half key that a single node has cannot meet another one; it is dropped before the pairs
   are formed, so only nodes with possible partners have table keys.
3. In each bucket all nodes are compared with one hub (the node with most keys), on their full
   sets. The links found join nodes to components, by rounds of minimum labels.
4. Nodes at a left half key that components share are compared across components. Pairs are formed by
   exact prefix filtering: shingles are ordered by how many of these nodes have them, rarest
   first, and a pair is formed at a shared shingle only if, from its place in both sets on, enough is
   left for the similarity asked for. No linked pair fails that, and copies of one text that differ
   in many places share no shingle early enough.
   Pairs within a component need no comparison: no link between them can change the result. So
   a group of copies costs its size, not its square.

Sets are compared as 64-bit hashes of the shingles. Null texts and texts without words have
the empty set, are linked with nothing and are kept. Texts with fewer words than a shingle are
one shingle. A row is known by its id and a hash of its text. Of each component one such row
survives, the first by id (nulls last) and text hash; rows without an id take part like all
others, and a component of such rows only has a null ``component_id``. Very long texts are whole sets
like others. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.base import HOT_SHARE, ship_package, spread_join, stored
from tallybrook.llm.tokens import groups, mixed, shingle_hashes, word_hashes

ROWS, TABLES = 3, 16
# Nodes that more pairs than this name have their sets dealt out in copies.
PAIRS_PER_COPY = 1000


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:count] | np.uint64(1), seeds[count:]


def half_keys(shingles: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The 2 * TABLES half keys of each row that has shingles; other rows have zeros."""
    full = np.flatnonzero(np.diff(edges))
    out = np.zeros((len(edges) - 1, 2 * TABLES), np.uint64)
    if not len(full):
        return out
    scale, shift = _functions(2 * TABLES * ROWS)
    for t in range(2 * TABLES):
        key = np.full(len(full), t + 1, np.uint64)
        for r in range(ROWS):
            k = t * ROWS + r
            values = (shingles * scale[k] + shift[k]) >> np.uint64(24)
            key = mixed(key * np.uint64(0x9FB21C651E98DF25) + np.minimum.reduceat(values, edges[full]))
        out[full, t] = key
    return out


def _sets(column: pa.Array, size: int):
    """(first row, distinct sorted shingle hashes of each row, all shingles, their edges) by groups of rows."""
    for first, data, offsets in groups(column):
        shingles, edges = shingle_hashes(*word_hashes(data, offsets), size)
        yield first, [np.unique(shingles[a:b]) for a, b in zip(edges, edges[1:])], shingles, edges


def _node(own: np.ndarray) -> bytes | None:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, counts, keys = [], [], []
            for _, sets, shingles, edges in _sets(batch.column("text"), size):
                nodes += map(_node, sets)
                counts += map(len, sets)
                keys += list(half_keys(shingles, edges).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(nodes, pa.binary()), pa.array(counts, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "text_key", "node", "n_shingles", "halves"])

    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, shingles = [], []
            for _, sets, *_ in _sets(batch.column("text"), size):
                nodes += map(_node, sets)
                shingles += [own.view(np.int64) for own in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(shingles, pa.list_(pa.int64()))], ["node", "shingles"])

    return run


def table_keys(nodes: DataFrame) -> DataFrame:
    """``node, bucket, support``: a row for each table in which the node may meet another."""
    halves = nodes.select("node", F.posexplode("halves").alias("t", "key"))
    met = halves.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("key").alias("met"))
    alive = halves.join(met, F.col("key") == F.col("met"), "left_semi").groupBy("node").agg(
        F.collect_list(F.when(F.col("t") < TABLES, F.col("key"))).alias("left"),
        F.collect_list(F.when(F.col("t") >= TABLES, F.col("key"))).alias("right"))
    return alive.withColumn("support", F.size("left") * F.size("right")).select(
        "node", "support", "right", F.explode("left").alias("a")).select(
        "node", "support", "a", F.explode("right").alias("b")).select(
        "node", "support", F.xxhash64("a", "b").alias("bucket"))


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """
    The pairs (a, b) whose full sets have at least ``percent`` % in common.

    A node with many pairs, as the hub of a large group, has its set dealt out in copies.
    """
    copies = stored(pairs.groupBy(F.col("a").alias("of")).agg(F.ceil(F.count("*") / PAIRS_PER_COPY).cast("int").alias("copies")).filter(
        "copies > 1"), "copies")
    dealt = spread_join(pairs, copies.withColumnRenamed("of", "a"), "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.coalesce("copies", F.lit(1))).cast("int").alias("copy"))
    other = sets.join(copies, F.col("node") == F.col("of"), "left").select(
        F.col("node").alias("a"), F.col("shingles").alias("left"),
        F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("copy"))
    one = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    both = dealt.join(one, "b").join(other, ["a", "copy"])
    common, left, right = F.size(F.array_intersect("left", "right")), F.size("left"), F.size("right")
    possible = 100 * F.least(left, right) >= percent * F.greatest(left, right)
    return both.filter(possible).filter(100 * common >= percent * (left + right - common)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that can be reached, for all nodes of ``links(a, b)``."""
    edges = stored(links.union(links.select("b", "a")).distinct(), "edges")
    labels = stored(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(
        F.col("a").alias("node"), "label"), "labels")
    while True:
        near = edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        next_ = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.least("label", "near").alias("label"), (F.col("near") < F.col("label")).alias("moved"))
        jump = next_.select(F.col("node").alias("at"), F.col("label").alias("further"))
        jumped = next_.join(jump, F.col("label") == F.col("at"), "left").select(
            "node", F.least("label", "further").alias("label"),
            (F.col("moved") | (F.col("further") < F.col("label"))).alias("moved"))
        moved = stored(jumped, "labels")
        labels = moved.select("node", "label")
        if not moved.filter("moved").head(1):
            return labels


def rare_shingles(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """
    ``shingle, node, label, n, reach``: the places of ``nodes(node, label)`` at which a pair may be formed.

    A set's shingles are in order of rarity among the nodes. Two sets of n and m shingles that first
    meet at places i and j share at most min(n - i, m - j), so ``reach``, the largest m that a place
    leaves possible, has to be at least the partner's size, and the other way round.
    """
    own = stored(sets.join(nodes, "node").select("node", "label", "shingles"), "open-sets")
    counts = stored(own.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("nodes")).filter(
        "nodes > 1"), "shared-shingles")
    # The most frequent ones, of which there are fewer than HOT_SHARE at any size, come last, in an order of their own.
    total = own.agg(F.sum(F.size("shingles")).alias("n")).first()["n"] or 0
    frequent = counts.filter(F.col("nodes") * HOT_SHARE > total).orderBy("nodes", "shingle").collect()
    last = F.array(*[F.lit(r.shingle) for r in frequent]).cast("array<bigint>")
    base = own.select("node", "label", F.size("shingles").alias("n"), F.array_except("shingles", last).alias("rare"),
                      F.array_intersect(last, F.col("shingles")).alias("frequent"))
    rare = base.select("node", "label", "n", F.explode("rare").alias("shingle")).join(counts, "shingle", "left").select(
        "node", "label", "n", F.coalesce("nodes", F.lit(1)).alias("nodes"), "shingle")
    common = base.select("node", "label", "n", F.posexplode("frequent").alias("k", "shingle")).select(
        "node", "label", "n", (F.col("k") + F.lit(1 << 60)).alias("nodes"), "shingle")
    order = F.sort_array(F.collect_list(F.struct("nodes", "shingle")))
    placed = rare.unionByName(common).groupBy("node", "label", "n").agg(order.alias("shingles")).select(
        "node", "label", "n", F.posexplode("shingles").alias("place", "at"))
    reach = F.floor(((100 + percent) * (F.col("n") - F.col("place")) - percent * F.col("n")) / percent)
    places = stored(placed.withColumn("reach", reach).filter(
        (F.col("at.nodes") > 1) & (100 * F.col("reach") >= percent * F.col("n"))).select(
        F.col("at.shingle").alias("shingle"), "node", "label", "n", "reach"), "places")
    # Of a shingle's places those go that cannot reach any other.
    ends = places.groupBy("shingle").agg(F.min("n").alias("least"), F.max("reach").alias("furthest"),
                                         F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return spread_join(places, ends, "shingle").filter("reach >= least and n <= furthest").select(*places.columns)


def across(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """
    The pairs (a, b) of ``nodes(node, label, halves)`` of different labels that may be linked, each once.

    Only nodes at a left half key with several labels take part. Of the labels that meet at a shingle,
    the nodes of the most frequent one are not compared with each other.
    """
    keyed = nodes.select("node", "label", F.explode(F.slice("halves", 1, TABLES)).alias("key"))
    several = keyed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    places = stored(rare_shingles(keyed.join(several, "key", "left_semi").select("node", "label").distinct(), sets, percent), "meeting")
    counts = places.groupBy("shingle", "label").agg(F.count("*").alias("n"))
    most = counts.groupBy("shingle").agg(F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("labels")).filter(
        "labels > 1").select("shingle", F.col("most.label").alias("main"))
    met = spread_join(places, most, "shingle").filter("main is not null")
    few = met.filter("label <> main").select(
        "shingle", F.col("node").alias("a"), F.col("label").alias("label_a"), F.col("n").alias("n_a"), F.col("reach").alias("reach_a"))
    other = met.select(F.col("shingle").alias("at"), "main", F.col("node").alias("b"), F.col("label").alias("label_b"),
                       F.col("n").alias("n_b"), F.col("reach").alias("reach_b"))
    once = (F.col("label_b") == F.col("main")) | (F.col("a") < F.col("b"))
    near = (F.col("n_b") <= F.col("reach_a")) & (F.col("n_a") <= F.col("reach_b"))
    return few.join(other, (F.col("shingle") == F.col("at")) & (F.col("label_a") != F.col("label_b")) & once & near).select("a", "b").distinct()


def node_labels(docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame | None:
    """``node, label`` of the nodes in components of two or more; None without candidates."""
    keys = stored(table_keys(nodes), "table-keys")
    hub = F.min(F.struct((-F.col("support")).alias("order"), F.col("node").alias("hub"))).alias("hub")
    buckets = keys.groupBy("bucket").agg(hub, F.count("*").alias("n")).filter("n > 1").select("bucket", "hub.hub")
    met = stored(keys.join(buckets, "bucket").filter("node <> hub"), "met")
    pairs = stored(met.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    held = nodes.join(asked, "node").select("doc_id", "text_key")
    # Copies without an id leave their task as one row.
    nameless = docs.filter("doc_id is null").dropDuplicates(["text_key"])
    texts = docs.join(held, ["doc_id", "text_key"], "left_semi").select("text").union(
        nameless.join(held.filter("doc_id is null"), "text_key", "left_semi").select("text"))
    sets = stored(texts.mapInArrow(_full_sets(size), "node binary, shingles array<long>").join(
        asked, "node", "left_semi").dropDuplicates(["node"]), "sets")
    links = stored(linked(pairs, sets, percent), "links")
    labels = components(links)
    unsettled = stored(nodes.select("node", "halves").join(asked, "node").join(labels, "node", "left").select(
        "node", "halves", F.coalesce("label", "node").alias("label")), "unsettled")
    more = stored(across(unsettled, sets, percent), "more-pairs")
    new = stored(linked(more, sets, percent), "more-links")
    return components(links.union(new)) if new.head(1) else labels


def _clustered(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, text_key, node, n_shingles, component_id, kept`` of every row."""
    ship_package(docs.sparkSession)
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    given = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {given}, text_key long, node binary, n_shingles long, halves array<long>"
    rows = stored(docs.mapInArrow(_signatures(size), schema).withColumn("row", F.monotonically_increasing_id()), "signatures")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key", "row")
    classes = stored(rows.filter("node is not null").groupBy("node").agg(F.min(order).alias("first")), "classes")
    nodes = rows.join(classes.select(F.col("first.row").alias("row")), "row", "left_semi").select(
        "node", "doc_id", "text_key", "halves")
    labels = node_labels(docs, nodes, size, percent)
    named = stored(classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "named")
    # One row per component and task leaves the partial aggregate.
    smallest = named.groupBy("label").agg(F.min("first").alias("best"))
    found = stored(spread_join(named, smallest, "label").select(F.col("node").alias("of"), "best"), "components")
    survives = F.when(F.col("doc_id").isNull(), F.col("row") == F.col("best.row")).otherwise(
        F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_key") == F.col("best.text_key")))
    return rows.drop("halves").join(found, F.col("node") == F.col("of"), "left").select(
        "doc_id", "text_key", "node", "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("component_id"),
        F.when(F.col("node").isNull(), F.lit(True)).otherwise(survives).alias("kept"))


def cluster(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """
    ``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest id that links lead to; ``kept`` marks the rows that have it. Of rows
    without an id one is marked, in a component of such rows only.
    """
    found = _clustered(docs, size, percent)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("kept")).alias("kept"))


def unique_documents(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component and all rows with an empty set, with all their columns."""
    known = _clustered(docs, size, percent).filter("node is not null").groupBy(
        F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key")).agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    known = stored(known.filter("not kept or rows > 1"), "not-single")
    # The columns of the rows are in a struct of their own, so their names meet no others.
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"))
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key"))
    # Of rows equal in id and text one stays; such groups leave a task as one row.
    repeated = keyed.join(known.filter("kept"), same, "left_semi").dropDuplicates(["id", "key"])
    return keyed.join(known, same, "left_anti").unionByName(repeated).select("row.*")
