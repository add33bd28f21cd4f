"""
Audit of how row filters interact, by counting paths through the lattice of filter subsets.

A state of the lattice is the set of filters applied so far, held as a bit mask; an edge leads
from a state to the one with a further filter, and an order of the filters is a path from the
empty state to the full one. What an edge removes depends on the rows left in its two states
only, never on the way there. So:

1. Each document is reduced to the mask of the filters that it fails, and these are counted by
   part. A mask is alive in each state that it shares no filter with; adding up gives the rows
   left in each state, one map per part.
2. Forward, the orders that reach a state are counted from the states before it; backward, the
   orders that leave it. The product for an edge's two ends is the number of orders through it.
3. An edge's removals, times its orders and added up by filter, give that filter's removals over
   all orders (its Shapley value times the number of orders). Each order's steps are read from the
   same edges; nothing is counted per order.

Null texts count as empty, null parts as the empty string; these meet the empty ones. A document
with a null id is never a copy, nor does it make others copies. Rows equal in id and text are no
copies of each other and count each. Where ``labels`` has several rows for an id, any 1 counts;
null ids and ids without a label are neither good nor toxic. An empty table has no parts and gives
no rows. Whole texts are read, of any length. Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.base import spread_join, stored

WORD_GAP = r"[\x20\x09-\x0D]+"
#: The filters of the contract, in the order of their bits.
FILTERS = ("A", "B", "C", "D", "E")
#: Orders grow as the factorial of the filters: so many are listed at most.
MOST = 7


def paths(count: int) -> list[tuple[int, int, int, int]]:
    """(state, filter, next state, number of orders through this edge) of each edge."""
    states = range(1 << count)
    reach, leave = [1] + [0] * (len(states) - 1), [0] * (len(states) - 1) + [1]
    for state in states:
        for f in range(count):
            if not state >> f & 1:
                reach[state | 1 << f] += reach[state]
    for state in reversed(states):
        for f in range(count):
            if state >> f & 1:
                leave[state ^ 1 << f] += leave[state]
    return [(state, f, state | 1 << f, reach[state] * leave[state | 1 << f])
            for state in states for f in range(count) if not state >> f & 1]


def order_steps(names: tuple[str, ...]) -> list[tuple[str, int, int, int]]:
    """(order, step from 1, state before it, filter) of each step of each order."""
    out = []
    for order in permutations(range(len(names))):
        state = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(names[k] for k in order), step, state, f))
            state |= 1 << f
    return out


def survivors(counted: DataFrame, count: int) -> DataFrame:
    """
    ``part, left``: for each part a map from state to the rows left in it.

    ``counted(part, fails, n, good, toxic)`` holds numbers of rows by the mask they fail.
    """
    states = F.array(*[F.lit(s) for s in range(1 << count)])
    alive = counted.select("part", "n", "good", "toxic", F.explode(
        F.filter(states, lambda s: s.bitwiseAND(F.col("fails")) == 0)).alias("state"))
    # A partial sum per part, state and task; a part has one row per state after that.
    summed = alive.groupBy("part", "state").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    known = counted.select("part").distinct().withColumnRenamed("part", "of")
    maps = summed.groupBy("part").agg(F.map_from_entries(F.collect_list(
        F.struct("state", F.struct("n", "good", "toxic")))).alias("left"))
    empty = F.create_map().cast("map<int,struct<n:bigint,good:bigint,toxic:bigint>>")
    return known.join(maps, F.col("of") == F.col("part"), "left").select(
        F.col("of").alias("part"), F.coalesce("left", empty).alias("left"))


def audit(counted: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """
    One row per part, order of the filters ``names`` and step, with the counts of that step.

    ``counted(part, fails, n, good, toxic)``: rows and labelled rows by part and failing mask (int).
    """
    if not 0 < len(names) <= MOST:
        raise ValueError(f"between 1 and {MOST} filters can be audited, not {len(names)}")
    spark, whole = counted.sparkSession, (1 << len(names)) - 1
    edges = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(t).alias("next"), F.lit(w).alias("orders"))
                      for s, f, t, w in paths(len(names))])

    def left(state: Column, field: str) -> Column:
        return F.coalesce(F.try_element_at("left", state)[field], F.lit(0))

    def lost(before: Column, after: Column, field: str = "n") -> Column:
        return left(before, field) - left(after, field)

    steps = survivors(counted, len(names)).withColumn("edge", F.explode(edges)).select("part", "left", "edge.*")
    own = F.call_function("shiftleft", F.lit(1), F.col("filter"))
    steps = steps.select(
        "part", "state", "filter", "orders", left(F.col("next"), "n").alias("kept"),
        lost(F.col("state"), F.col("next")).alias("removed"),
        # All that fail the filter go on its edge from the empty state, those that fail it only on its last edge.
        lost(F.lit(0), own).alias("failing"), lost(F.lit(whole).bitwiseXOR(own), F.lit(whole)).alias("unique_fails"),
        lost(F.col("state"), F.col("next"), "good").alias("good_lost"),
        lost(F.col("state"), F.col("next"), "toxic").alias("toxic_lost"))
    shares = steps.groupBy(F.col("part").alias("of"), F.col("filter").alias("by")).agg(
        F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    steps = steps.join(shares, (F.col("part") == F.col("of")) & (F.col("filter") == F.col("by")))
    orders = spark.createDataFrame(order_steps(names), "filter_order string, step int, before int, f int")
    return steps.join(F.broadcast(orders), (F.col("state") == F.col("before")) & (F.col("filter") == F.col("f"))).select(
        "part", "filter_order", "step", "kept", "removed", (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", "shapley")


def failing(docs: DataFrame) -> DataFrame:
    """
    ``doc_id, part, fails, n``: the mask of ``FILTERS`` that each document of ``docs(doc_id, text,
    source)`` fails; ``n`` counts rows equal in id, part and text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split("text", WORD_GAP, -1), "")
    read = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text")).select(
        "doc_id", "part", "text", words.alias("words"))
    n_words, distinct = F.size("words"), F.size(F.array_distinct("words"))
    conditions = (
        n_words < 50,
        100 * distinct < 65 * n_words,
        100 * F.regexp_count("text", F.lit("[A-Z]")).cast("long") > 5 * F.length("text").cast("long"),
        F.col("text").rlike(r"[#$%&*|]"),
    )
    mask = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions)), F.lit(0))
    # The texts end here. Repeated rows leave a task as one row.
    rows = stored(read.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("fails")).groupBy(
        "doc_id", "part", "digest", "fails").agg(F.count("*").alias("n")), "failing")
    firsts = rows.groupBy(F.col("digest").alias("of")).agg(F.min("doc_id").alias("first"))
    # Joined on digest and id, as a text that a third of all documents share is no hot key then.
    named = rows.filter("doc_id is not null").join(
        firsts, (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("first")), "left")
    copy = F.when(F.col("first").isNull(), 1 << 4).otherwise(0)
    return named.select("doc_id", "part", F.col("fails").bitwiseOR(copy).alias("fails"), "n").unionByName(
        rows.filter("doc_id is null").select("doc_id", "part", "fails", "n"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``FILTERS`` over ``docs(doc_id, text, source)`` and ``labels(doc_id, quality, toxic)``, by source."""
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).filter("good + toxic > 0")
    rows = stored(failing(docs), "masks")
    marked = spread_join(rows.filter("doc_id is not null"), marks, "doc_id").select("part", "fails", "n", "good", "toxic").unionByName(
        rows.filter("doc_id is null").select("part", "fails", "n", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic")))
    counted = marked.groupBy("part", "fails").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))
    return audit(stored(counted, "mask-counts"), FILTERS)
