"""
Distinct editors that merge exactly, at any number of editors.

Each editor gets a number once; the editors of a key are then bitmaps, one of 32,768 numbers per
bucket. Bitmaps of days or batches are merged by or, so that an editor of several of them is counted
once, and a merge costs the buckets, not the editors. Numbers are given without gaps, as a
bitmap has 4 KB however few of its bits are set.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PER_CHUNK = 100_000


def number_editors(users: DataFrame, known: DataFrame, per_chunk: int = PER_CHUNK) -> DataFrame:
    """
    ``user, number`` for each user of ``users(user)`` that ``known(user, number)`` has not; null is no user.

    Numbers go on from the largest known one, in order of chunk and name, so the same users get the same
    numbers again. Users are ordered in chunks of about ``per_chunk``, dealt by a hash.
    """
    fresh = users.select("user").filter("user is not null").distinct().join(known.select("user"), "user", "left_anti")
    taken = known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("n")).first()["n"]
    chunks = max(1, ceil(fresh.count() / per_chunk))
    dealt = fresh.withColumn("chunk", F.pmod(F.xxhash64("user"), F.lit(chunks)))
    # A row per chunk.
    sizes = dealt.groupBy("chunk").agg(F.count("*").alias("size"))
    so_far = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("chunk", F.coalesce(F.sum("size").over(so_far), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("chunk").orderBy("user"))
    return dealt.withColumn("place", place).join(F.broadcast(first), "chunk").select(
        "user", (F.lit(taken) + F.col("first") + F.col("place")).alias("number"))


def editor_bitmaps(edits: DataFrame, numbers: DataFrame, *keys) -> DataFrame:
    """
    Per key and bucket the bitmap of the editors of ``edits``. An editor leaves a task once per key, and is
    joined with its number once per key, however many edits there are.
    """
    unique = edits.select(*keys, "user").filter("user is not null").distinct()
    names = [c for c in unique.columns if c != "user"]
    numbered = unique.join(numbers, "user").withColumn("bucket", F.bitmap_bucket_number("number"))
    return numbered.groupBy(*names, "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence) -> DataFrame:
    """Bitmaps of several days or batches as one per key and bucket."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_editors(bitmaps: DataFrame, keys: Sequence) -> DataFrame:
    """Distinct editors per key over all of its bitmaps, exact."""
    merged = merge_bitmaps(bitmaps, keys)
    names = [c for c in merged.columns if c not in ("bucket", "bitmap")]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bitmap")).alias("editors"))
