"""The live path: tumbling windows under one watermark, written as versioned slices."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybrook.operators.lateness import window_grid
from tallybrook.operators.windows import event_clock, latest_version, normalize, pack_slices
from tallybrook.schemas import LAST_WINDOWS, SLICE
from tallybrook.settings import GRACE_SECONDS, WINDOW_SECONDS
from tallybrook.sources.tables import BATCH, append_batch, bound_checkpoint, read_table, stored_batches, stored_days

KEYS = ["window_start", "partition"]
# Beside the slices, and no part of their table.
LAST = "_last"


def stream_clock(edits: DataFrame, source: str) -> DataFrame:
    """Add ``clock``, the time an edit counts under; it is never moved."""
    return edits.withColumn("clock", event_clock(edits, source).cast("timestamp"))


def live_counts(edits: DataFrame, size: int = WINDOW_SECONDS, grace: float = GRACE_SECONDS) -> DataFrame:
    """
    Counts per (window, partition, dimension, value) of closed windows. A window closes
    once the watermark, ``grace`` behind the newest clock, reaches its end; what arrives
    for it after that is dropped and counted by the query's progress.

    State holds one row per value, reduced in each task before it is shuffled, so neither
    a busy wiki nor a busy topic partition is gathered in one place.
    """
    dims = F.explode(F.array(*[
        F.struct(F.lit(name).alias("dim"), F.col(name).alias("value"))
        for name in ("wiki", "type", "user")
    ]))
    return (
        normalize(edits)
        .withWatermark("clock", f"{int(grace * 1000)} milliseconds")
        .select("clock", F.col("kafka_partition").alias("partition"), "bot", dims.alias("d"))
        .groupBy(F.window("clock", f"{size} seconds").alias("w"), "partition", "d.dim", "d.value")
        .agg(F.count("*").alias("n"), F.count_if(F.col("bot")).alias("bots"))
        .select(
            F.unix_seconds("w.start").alias("window_start"), "partition", "dim", "value", "n", "bots"
        )
    )


def slices_of_counts(counts: DataFrame, size: int) -> DataFrame:
    """Long-form counts of all three dimensions as slices."""
    users = counts.filter(F.col("dim") == "user").select(
        *KEYS, F.col("value").alias("user"), F.col("n").alias("count")
    )
    return pack_slices(counts.filter(F.col("dim") != "user"), users, size)


def write_slices(slices: DataFrame, folder: str, batch_id: int) -> None:
    """Write one batch of slices with the time of writing, unless they have it, which lifetimes and delays go by."""
    if "written_at" not in slices.columns:
        slices = slices.withColumn("written_at", F.current_timestamp())
    append_batch(
        slices, folder, batch_id, F.to_date(F.timestamp_seconds("window_start")), date_name="window_date", order=KEYS,
    )


def read_slices(spark: SparkSession, folder: str, since: str) -> DataFrame:
    """The newest write of every (window, partition), of the days from ``since`` on."""
    table = read_table(spark, folder, SLICE, date_name="window_date")
    table = table.filter(F.col("window_date") >= F.lit(since).cast("date")).drop("window_date")
    return latest_version(table, KEYS, BATCH).drop(BATCH)


def newest_slices(spark: SparkSession, folder: str, windows: int) -> DataFrame:
    """
    The slices of the newest ``windows`` windows. Days are known from their folders' names; the newest are read
    first, as many as it takes to hold so many windows, so history costs nothing however long it is.
    """
    days = stored_days(spark, folder, "window_date")
    if not days:
        return spark.createDataFrame([], SLICE)
    table, taken = read_table(spark, folder, SLICE, date_name="window_date"), 1
    while True:
        part = table.filter(F.col("window_date") >= F.lit(days[-min(taken, len(days))]).cast("date"))
        starts = part.select("window_start").distinct().orderBy(F.col("window_start").desc()).limit(windows)
        held, oldest = starts.agg(F.count("*"), F.min("window_start")).first()
        if held == windows or taken >= len(days):
            break
        taken *= 4
    if not held:
        return spark.createDataFrame([], SLICE)
    bound = F.col("window_date") >= F.to_date(F.timestamp_seconds(F.lit(oldest)))
    rows = table.filter(bound & (F.col("window_start") >= oldest)).drop("window_date")
    return latest_version(rows, KEYS, BATCH).drop(BATCH)


def last_windows(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    """``partition, window_start``: up to where each partition's windows were written before a batch."""
    path = f"{folder}/{LAST}"
    before = [n for n in stored_batches(spark, path) if n < batch_id]
    if not before:
        return spark.createDataFrame([], LAST_WINDOWS)
    return read_table(spark, path, LAST_WINDOWS, date_name="window_date").filter(
        F.col(BATCH) == max(before)).select("partition", "window_start")


def zero_slices(slices: DataFrame, last: DataFrame, newest: int, size: int) -> DataFrame:
    """
    Slices of the windows up to ``newest`` in which a partition had nothing: from the one after its ``last``,
    or from its first slice on. A partition that has gone quiet has them too.
    """
    first = slices.groupBy("partition").agg(F.min("window_start").alias("first"))
    spans = first.join(last, "partition", "full").select(
        "partition", F.coalesce(F.col("window_start") + size, F.col("first")).alias("first"), F.lit(newest).alias("last"))
    empty = window_grid(spans.filter("first <= last"), size, ("partition",)).join(slices, KEYS, "left_anti")
    none, zero = F.array(), F.lit(0).cast("long")
    values = {
        "window_end": F.col("window_start") + size, "total_edits": zero, "edits_per_second": F.lit(0.0), "edits_per_wiki": none,
        "bot_vs_human": F.struct(zero.alias("bot"), zero.alias("human")), "edit_types": none, "top_editors": none,
    }
    kinds = {f.name: f.dataType for f in slices.schema}
    return empty.withColumns({name: value.cast(kinds[name]) for name, value in values.items()}).select(*slices.columns)


def write_closed(slices: DataFrame, folder: str, batch_id: int, size: int) -> None:
    """
    Write a batch of closed windows with the empty ones between them and the batches before, so each
    partition's series has no gaps. The batch also notes up to where it wrote, for the next one.
    """
    spark = slices.sparkSession
    slices = slices.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        last = last_windows(spark, folder, batch_id)
        newest = slices.agg(F.max("window_start")).first()[0]
        reached = last
        if newest is not None:
            write_slices(slices.unionByName(zero_slices(slices, last, newest, size)), folder, batch_id)
            known = slices.select("partition").union(last.select("partition")).distinct()
            reached = known.withColumn("window_start", F.lit(newest))
        append_batch(reached, f"{folder}/{LAST}", batch_id, F.to_date(F.timestamp_seconds("window_start")), date_name="window_date")
    finally:
        slices.unpersist()


def start_live_windows(
    edits: DataFrame, folder: str, checkpoint: str | None = None, *, source: str = "event",
    size: int = WINDOW_SECONDS, grace: float = GRACE_SECONDS,
    trigger: dict | None = None, first_batch: int = 0,
) -> StreamingQuery:
    """
    Write a slice for every window and partition as the window closes, with zeros where a partition had nothing.
    """

    def write(batch: DataFrame, n: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_closed(slices_of_counts(batch, size), folder, first_batch + n, size)
        finally:
            batch.unpersist()

    return (
        live_counts(stream_clock(edits, source), size, grace)
        .writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", bound_checkpoint(edits.sparkSession, folder, checkpoint, first_batch))
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def start_live_totals(
    edits: DataFrame, folder: str, checkpoint: str | None = None, *, source: str = "event",
    size: int = WINDOW_SECONDS, grace: float = GRACE_SECONDS, trigger: dict | None = None,
    first_batch: int = 0,
) -> StreamingQuery:
    """
    Write every change of a window's total as a new version, for clients that follow
    windows while they fill (``operators.windows.window_changes``).
    """
    totals = (
        stream_clock(edits, source)
        .withWatermark("clock", f"{int(grace * 1000)} milliseconds")
        .groupBy(F.window("clock", f"{size} seconds").alias("w"))
        .agg(F.count("*").alias("total"))
        .select(F.unix_seconds("w.start").alias("window_start"), "total")
    )

    def write(batch: DataFrame, n: int) -> None:
        append_batch(
            batch, folder, first_batch + n, F.to_date(F.timestamp_seconds("window_start")),
            date_name="window_date", order=("window_start",),
        )

    return (
        totals.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", bound_checkpoint(edits.sparkSession, folder, checkpoint, first_batch))
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )
