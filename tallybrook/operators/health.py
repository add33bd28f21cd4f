"""State of both paths and the checks between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.clock import AsOf, as_of_column, bucket_start, epoch_seconds
from tallybrook.settings import COLD_MAX_AGE_SECONDS, STALE_AFTER_SECONDS


def cold_path_health(
    edits: DataFrame, errors: DataFrame, as_of: AsOf = None, max_age: float = COLD_MAX_AGE_SECONDS,
    grown_since: AsOf = None,
) -> DataFrame:
    """
    One status row: rows stored, rows newer than ``grown_since``, age of the newest, dead
    letters, and whether all of it is as it should be. Two map-side combined counts.
    """
    now = as_of_column(edits, "ingested_at", as_of)
    since = as_of_column(edits, "ingested_at", as_of if grown_since is None else grown_since)
    stored = edits.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("ingested_at") >= since).alias("new_rows"),
        F.max("ingested_at").alias("newest"),
    )
    failed = errors.agg(F.count("*").alias("dead_letters"))
    age = (F.unix_millis(now.cast("timestamp")) - F.unix_millis(F.col("newest").cast("timestamp"))) / 1000.0
    row = stored.unionByName(failed, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("rows", "new_rows", "newest", "dead_letters")]
    )
    fresh = F.col("age_seconds") <= max_age
    return row.withColumn("age_seconds", age).select(
        "rows",
        "new_rows",
        "age_seconds",
        "dead_letters",
        F.when(F.col("rows") == 0, "empty").when(fresh, "ok").otherwise("stale").alias("state"),
        F.coalesce(
            (F.col("rows") > 0) & (F.col("new_rows") > 0) & fresh & (F.col("dead_letters") == 0),
            F.lit(False),
        ).alias("healthy"),
    )


def live_path_health(slices: DataFrame, as_of_epoch: int, stale_after: float = STALE_AFTER_SECONDS) -> DataFrame:
    """Status of the live path by its newest window, and how many partitions that has so far."""
    # The newest window of each partition first: a row per partition decides.
    heads = slices.groupBy("partition").agg(F.max(F.struct("window_start", "window_end")).alias("w"))
    newest = heads.groupBy("w").agg(F.count("*").alias("n")).agg(F.max(F.struct("w", "n")).alias("top")).select(
        "top.w.window_start", "top.w.window_end", F.coalesce("top.n", F.lit(0)).alias("partitions"))
    age = F.lit(as_of_epoch) - F.col("window_end")
    return newest.select(
        F.col("window_start").alias("latest_window"),
        age.alias("age_seconds"),
        "partitions",
        F.when(F.col("window_start").isNull(), "no windows")
        .when(age > stale_after, "no recent window")
        .otherwise("ok")
        .alias("status"),
    )


def reconcile_hot_cold(windows: DataFrame, minute: DataFrame, size: int) -> DataFrame:
    """
    Live totals against the minute rollup on windows of ``size`` seconds (whole minutes).
    A difference is a double count or a loss on one side.
    """
    hot = windows.groupBy(F.col("window_start").alias("t")).agg(F.sum("total").alias("hot_edits"))
    cold = minute.groupBy(epoch_seconds(bucket_start(F.col("minute"), size)).alias("t")).agg(
        F.sum("edits").alias("cold_edits")
    )
    difference = F.coalesce("cold_edits", F.lit(0)) - F.coalesce("hot_edits", F.lit(0))
    return hot.join(cold, "t", "full").select(
        "t",
        "hot_edits",
        "cold_edits",
        difference.alias("difference"),
        F.when(F.col("hot_edits").isNull(), "cold only")
        .when(F.col("cold_edits").isNull(), "hot only")
        .when(difference == 0, "equal")
        .otherwise("differs")
        .alias("verdict"),
    )


def emit_delay(emitted: DataFrame, size: int) -> DataFrame:
    """Seconds between the end of a window and the moment it was written (``written_at``, epoch)."""
    return emitted.withColumn("delay_seconds", (F.col("written_at") - (F.col("window_start") + F.lit(size))).cast("double"))


def slice_delays(slices: DataFrame) -> DataFrame:
    """Emit delay of written slices, from the time of writing that they carry."""
    written = F.unix_micros("written_at") / F.lit(1_000_000.0)
    return slices.select(
        "window_start", "partition", (written - F.col("window_end")).alias("delay_seconds"))


def consumer_lag(latest: DataFrame, committed: DataFrame) -> DataFrame:
    """
    Messages each partition is behind: end of the log minus the next offset to read,
    with the total over all partitions beside it. One row per partition on both sides.
    """
    keys = [c for c in ("topic", "partition") if c in latest.columns and c in committed.columns]
    lag = latest.join(committed, keys, "left").select(
        *keys,
        (F.col("end_offset") - F.coalesce("committed", F.lit(0))).alias("lag"),
    )
    # A row per topic partition.
    total = lag.agg(F.sum("lag").alias("total_lag"), F.collect_list(F.struct(*keys, "lag")).alias("rows"))
    return total.select(F.explode("rows").alias("r"), "total_lag").select("r.*", "total_lag")
