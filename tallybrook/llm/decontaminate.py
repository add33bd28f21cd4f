"""
Benchmark decontamination: training documents that hold passages of a benchmark.

A window is ten consecutive words of an item; an item with fewer words is one window. The
distinct windows are the broadcast hash set. Each window is keyed by one of its words, its
longest, and a document's words are met with these keys in one pass; where a key is met, the
window around it is compared word by word. Only DataFrame operations are used.

Null texts and texts without words have no words and no hits; a null id is an id like any
other. Rows equal in doc_id and text are one document. Empty tables give empty results or no
hits. Other columns are not read, so their names may be anything.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.base import (
    BROADCAST_BYTES, SENTINEL, WORD_GAP, ascii_lower, covered, scan_words, words_between,
)

WINDOW = 10


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct windows: ``window`` (its words joined by blanks), ``n``, its items, its key word and place."""
    words = F.filter(F.split(ascii_lower(F.coalesce("text", F.lit(""))), WORD_GAP, -1), lambda w: w != "")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words.alias("ws")).filter(
        F.size("ws") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("ws") - size + 1))
    windows = items.withColumn("start", F.explode(starts)).select(
        "item_id", F.slice("ws", F.col("start"), size).alias("ws"))
    joined = windows.groupBy("ws").agg(F.collect_set("item_id").alias("items"))
    longest = F.array_max(F.transform("ws", lambda w: F.length(w)))
    key_at = F.array_position(F.transform("ws", lambda w: F.length(w)), longest) - 1
    return joined.withColumn("key_at", key_at).select(
        F.lower(F.element_at("ws", (F.col("key_at") + 1).cast("int"))).alias("word"), "key_at",
        F.array_join("ws", " ").alias("window"), F.size("ws").alias("n"), "items")


def _blocks(windows: DataFrame) -> list[DataFrame]:
    """The windows in blocks that are each small enough to broadcast; mostly one."""
    held = windows.select(
        (F.length("window") * 4 + F.aggregate("items", F.lit(0), lambda n, i: n + F.length(i) * 4 + 16) + 64).alias("b"))
    total = held.agg(F.sum("b")).first()[0] or 0
    count = max(1, ceil(2 * total / BROADCAST_BYTES))
    if count == 1:
        return [windows]
    return [windows.filter(F.pmod(F.xxhash64("window"), F.lit(count)) == k) for k in range(count)]


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """
    One row per document: ``doc_id, text_key, n_words, spans`` (sorted word ranges that equal a
    window, end exclusive) and ``items`` (ids as strings of the items with such a window).
    """
    windows = benchmark_windows(benchmark, size)
    spark = docs.sparkSession
    found = None
    for block in _blocks(windows):
        mark = spark.range(1).select(
            F.lit(SENTINEL).alias("word"), F.lit(0).cast("long").alias("key_at"),
            F.lit(None).cast("string").alias("window"), F.lit(0).alias("n"),
            F.array().cast("array<string>").alias("items"))
        met = scan_words(docs, block.unionByName(mark))
        start = F.col("pos") - F.col("key_at")
        is_mark = F.col("word") == SENTINEL
        fits = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
        same = F.when(fits, words_between(start.cast("int"), F.col("n")) == F.col("window"))
        hits = met.filter(is_mark | same).select(
            "doc_id", "text_key", "n_words",
            F.when(~is_mark, F.struct(start.cast("long").alias("start"),
                                      (start + F.col("n")).cast("long").alias("end"))).alias("span"),
            "items")
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy("doc_id", "text_key").agg(
        F.first("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents without any window of the benchmark, with all their columns."""
    hit = contamination(docs.select("doc_id", "text"), benchmark, size).filter(F.size("spans") > 0).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    same = docs["doc_id"].eqNullSafe(hit["__id"]) & (F.xxhash64(docs["text"]) == hit["__key"])
    return docs.join(hit, same, "left_anti")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    n_hit = covered(F.col("spans"))
    return contamination(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))
