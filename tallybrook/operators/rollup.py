"""Minute and day rollups with mergeable distinct-editor state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.clock import bucket_start
from tallybrook.functions.sketches import editors_estimate, editors_merge, editors_state


def rollup_minute(edits: DataFrame, *batch: str) -> DataFrame:
    """
    Per minute and wiki (and the ``batch`` columns rows arrived in, if any): edits, bot edits, new pages and the distinct-editor state.

    One shuffle of partial aggregates: a wiki holding a third of the rows leaves each
    task as one partial row per minute. Counts the rows it is given; feed it
    deduplicated edits to keep redeliveries out.
    """
    return edits.groupBy(bucket_start(F.col("ingested_at"), 60).alias("minute"), "wiki", *batch).agg(
        F.count("*").alias("edits"),
        F.count_if(F.col("bot")).alias("bot_edits"),
        F.count_if(F.col("type") == "new").alias("new_pages"),
        editors_state(F.col("user")).alias("editors"),
    )


def merge_rollups(parts: DataFrame, *keys) -> DataFrame:
    """
    Add up rollup rows by ``keys``. Batches append partial rows, so every reader goes
    through this, also for the rollup's own key.
    """
    return parts.groupBy(*keys).agg(
        F.sum("edits").alias("edits"),
        F.sum("bot_edits").alias("bot_edits"),
        F.sum("new_pages").alias("new_pages"),
        editors_merge(F.col("editors")).alias("editors"),
    )


def rollup_day(minute: DataFrame) -> DataFrame:
    """The day rollup, chained off the minute rollup: states are merged, not recomputed."""
    return merge_rollups(minute, F.to_date("minute").alias("day"), "wiki")


def rollup_read(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial rows of several batches as one row per key."""
    return merge_rollups(parts, *keys)


def with_estimates(rollup: DataFrame) -> DataFrame:
    """Replace the editor state by the number it stands for."""
    return rollup.withColumn("editors", editors_estimate(F.col("editors")))


def distinct_editors(edits: DataFrame, *keys) -> DataFrame:
    """Distinct editors per key, exact: editors are made unique first, then counted."""
    unique = edits.select(*keys, "user").distinct()
    return unique.groupBy(*keys).agg(F.count("user").alias("editors"))
