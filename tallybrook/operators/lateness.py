"""
Per-partition watermarks, late events, closed and gap-free windows.

Input rows carry ``kafka_partition``, ``kafka_offset`` and an event clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.clock import align_micros, epoch_micros
from tallybrook.operators.ordered import offset_chunk, previous, running_max

DAY = 86_400
PARTITION = "kafka_partition"
OFFSET = "kafka_offset"


def clocked(events: DataFrame, ts: Column, size: int) -> DataFrame:
    """Add the clock in microseconds and the window it falls into."""
    return events.withColumn("clock_us", epoch_micros(ts)).withColumn(
        "window_start", align_micros(F.col("clock_us"), size)
    )


def partition_watermark(events: DataFrame, ts: Column) -> DataFrame:
    """The highest clock seen per partition. It never goes back."""
    return events.groupBy(PARTITION).agg(F.max(ts).alias("watermark"))


def running_watermark(events: DataFrame, ts: Column, chunk: Column | None = None) -> DataFrame:
    """Each row with its partition's watermark before and after it, in offset order."""
    rows = events.withColumn("clock_us", epoch_micros(ts))
    chunk = offset_chunk() if chunk is None else chunk
    rows = running_max(
        rows, [PARTITION], OFFSET, "clock_us", chunk, name="before_us", include_current=False
    )
    return rows.withColumn("watermark_us", F.greatest("before_us", "clock_us"))


def late_events(events: DataFrame, ts: Column, size: int, grace: float, chunk: Column | None = None) -> DataFrame:
    """
    Rows whose window was closed by the rows before them, flushing after every row:
    the window's end plus grace had been reached by the partition's earlier watermark.
    """
    rows = running_watermark(events, ts, chunk)
    start = align_micros(F.col("clock_us"), size)
    closed_at = (start + F.lit(size)) * F.lit(1_000_000) + F.lit(int(grace * 1_000_000))
    return rows.withColumn("window_start", start).filter(closed_at <= F.col("before_us"))


def origins(events: DataFrame, ts: Column, size: int) -> DataFrame:
    """The window of each partition's first row. Nothing before it is ever emitted."""
    return clocked(events, ts, size).groupBy(PARTITION).agg(
        F.min_by("window_start", OFFSET).alias("origin")
    )


def apply_origin(events: DataFrame, ts: Column, size: int) -> DataFrame:
    """Rows with ``before_origin`` set where they predate their partition's first window."""
    rows = clocked(events, ts, size)
    # One row per topic partition, a number the topic fixes.
    first = F.broadcast(origins(events, ts, size))
    return rows.join(first, PARTITION).withColumn(
        "before_origin", F.col("window_start") < F.col("origin")
    )


def disposition(events: DataFrame, ts: Column, size: int, grace: float, chunk: Column | None = None) -> DataFrame:
    """
    Events per partition by what became of them: late (their window was closed by the rows before
    them), closed (their window is closed by now) or open.
    """
    rows = running_watermark(events, ts, chunk).withColumn("window_start", align_micros(F.col("clock_us"), size))
    closes = (F.col("window_start") + F.lit(size)) * F.lit(1_000_000) + F.lit(int(grace * 1_000_000))
    # One row per topic partition, a number the topic fixes.
    marks = events.groupBy(PARTITION).agg(F.max(epoch_micros(ts)).alias("mark_us"))
    late = F.coalesce(closes <= F.col("before_us"), F.lit(False))
    rows = rows.join(F.broadcast(marks), PARTITION).withColumns({"late": late, "closed": ~late & (closes <= F.col("mark_us"))})
    return rows.groupBy(PARTITION).agg(
        F.count_if("late").alias("late_events"), F.count_if("closed").alias("closed_events"),
        F.count_if(~F.col("late") & ~F.col("closed")).alias("open_events"))


def restart_offsets(events: DataFrame, ts: Column, size: int, grace: float) -> DataFrame:
    """
    Per partition, the lowest offset that a window still open needs (``safe``), beside the end of the
    log. Reading from there on loses nothing; what closed windows have of it is counted twice unless it is dropped.
    """
    marks = events.groupBy(PARTITION).agg(F.max(epoch_micros(ts)).alias("mark_us"), (F.max(OFFSET) + 1).alias("end_offset"))
    closes = (align_micros(epoch_micros(ts), size) + F.lit(size)) * F.lit(1_000_000) + F.lit(int(grace * 1_000_000))
    rows = events.select(PARTITION, OFFSET, closes.alias("closes")).join(F.broadcast(marks), PARTITION)
    return rows.groupBy(PARTITION, "end_offset").agg(F.min(F.when(F.col("closes") > F.col("mark_us"), F.col(OFFSET))).alias("open")).select(
        PARTITION, "end_offset", F.coalesce("open", "end_offset").alias("safe"))


# -- closed and gap-free windows ----------------------------------------------

def closed_windows(counts: DataFrame, watermarks: DataFrame, size: int, grace: float) -> DataFrame:
    """Windows whose end plus grace their partition's watermark has reached, boundary included."""
    closes = (F.col("window_start") + F.lit(size)) * F.lit(1_000_000) + F.lit(int(grace * 1_000_000))
    # One row per topic partition, a number the topic fixes.
    marks = watermarks.select(PARTITION, epoch_micros(F.col("watermark")).alias("_us"))
    return counts.join(F.broadcast(marks), PARTITION).filter(closes <= F.col("_us")).drop("_us")


def window_grid(spans: DataFrame, size: int, keys: tuple[str, ...] = (PARTITION,)) -> DataFrame:
    """
    Every window of each row of ``spans(*keys, first, last)``, both ends included. The grid grows with the time
    covered, not with the events, and is made day by day.
    """
    day = F.lit(DAY)
    # A row per key and day, dealt anew, before any window of a day is made.
    days = spans.withColumn("_day", F.explode(F.sequence(
        F.floor(F.col("first") / day), F.floor(F.col("last") / day)))).repartition(*keys, "_day")
    first = F.greatest(F.col("first"), F.col("first") + F.ceil((F.col("_day") * day - F.col("first")) / size) * size)
    last = F.least(F.col("last"), (F.col("_day") + 1) * day - 1)
    return days.withColumn("_first", first).filter(F.col("_first") <= last).select(
        *keys, F.explode(F.sequence(F.col("_first"), last, F.lit(size).cast("long"))).alias("window_start")
    )


def densify(counts: DataFrame, size: int, keys: tuple[str, ...] = (PARTITION,), measures: tuple[str, ...] = ("events",)) -> DataFrame:
    """Fill the windows between each key's first and last with zeros."""
    spans = counts.groupBy(*keys).agg(F.min("window_start").alias("first"), F.max("window_start").alias("last"))
    filled = window_grid(spans, size, keys).join(counts, [*keys, "window_start"], "left")
    return filled.select(
        *keys, "window_start", *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures]
    )


def fill_gaps(counts: DataFrame, size: int, max_gap: int | None = None, measures: tuple[str, ...] = ("events",)) -> DataFrame:
    """
    Each partition's windows with the empty ones between them as zeros, for a reader that follows them
    one by one. Of a gap of more than ``max_gap`` windows only the newest so many are
    filled in; ``skipped`` of the window after a gap says how many are not.

    Windows are ordered in chunks of a day, each with the newest window before it.
    """
    before = previous(counts, [PARTITION], "window_start", "window_start", F.floor(F.col("window_start") / DAY), name="_before")
    gap = F.coalesce(F.floor((F.col("window_start") - F.col("_before")) / size) - 1, F.lit(0))
    filled = gap if max_gap is None else F.least(gap, F.lit(max_gap).cast("long"))
    own = F.struct("window_start", *measures, (gap - filled).alias("skipped"))
    zeros = F.transform(
        F.sequence(F.col("window_start") - filled * size, F.col("window_start") - size, F.lit(size).cast("long")),
        lambda start: F.struct(start.alias("window_start"), *[F.lit(0).cast("long").alias(m) for m in measures],
                               F.lit(0).cast("long").alias("skipped")))
    every = F.when(filled > 0, F.concat(zeros, F.array(own))).otherwise(F.array(own))
    return before.select(PARTITION, F.explode(every).alias("w")).select(PARTITION, "w.*")


# -- windows as flushes emit them ----------------------------------------------

def _poll_counts(events: DataFrame, ts: Column, poll: Column, size: int) -> DataFrame:
    """Events per partition, poll and window, with their highest clock and lowest offset. Rows without a clock or a poll meet no flush."""
    rows = clocked(events, ts, size).withColumn("poll", poll).filter("window_start is not null and poll is not null")
    return rows.groupBy(PARTITION, "poll", "window_start").agg(
        F.count("*").alias("events"), F.max("clock_us").alias("_us"), F.min(OFFSET).alias("_low"))


def _flushes(counts: DataFrame, size: int, grace: float, polls_per_chunk: int) -> DataFrame:
    """
    Per partition and poll the newest window emitted ``before`` it and ``through`` the flush after it. A window
    closes once the watermark reaches its end plus grace; the one before a partition's first row counts as emitted.
    """
    polls = counts.groupBy(PARTITION, "poll").agg(F.max("_us").alias("_us"))
    first = F.min(F.struct("poll", F.col("_low").isNull().alias("unknown"), "_low", "window_start"))["window_start"]
    # One row per topic partition, a number the topic fixes.
    origin = F.broadcast(counts.groupBy(PARTITION).agg((first - F.lit(size)).alias("_origin")))
    chunk = F.floor(F.col("poll") / polls_per_chunk)
    marks = running_max(polls, [PARTITION], "poll", "_us", chunk, name="_earlier", include_current=False)

    def reach(mark: Column) -> Column:
        newest = align_micros(mark - F.lit(int(grace * 1_000_000)), size) - F.lit(size)
        return F.greatest(F.col("_origin"), newest)

    return marks.join(origin, PARTITION).select(
        PARTITION, "poll", F.when(F.col("_earlier").isNull(), F.col("_origin")).otherwise(reach(F.col("_earlier"))).alias("before"),
        reach(F.greatest("_earlier", "_us")).alias("through"))


def window_fates(
    events: DataFrame, ts: Column, poll: Column, size: int, grace: float, max_gap: int | None = None,
    polls_per_chunk: int = 10_000,
) -> DataFrame:
    """
    Per partition and window what its events came to, with a flush after each poll: on time (``events``) or too
    late (``late_events``), the poll that emitted it, and whether it is ``emitted``, ``open`` or, where a flush emits
    only the newest ``max_gap`` of the windows it closes, ``dropped``. Quiet windows are emitted with no events.
    """
    counts = _poll_counts(events, ts, poll, size)
    flushes = _flushes(counts, size, grace, polls_per_chunk)
    late = F.col("window_start") <= F.col("before")
    taken = counts.join(flushes, [PARTITION, "poll"]).groupBy(PARTITION, "window_start").agg(
        F.sum(F.when(~late, F.col("events"))).alias("events"), F.sum(F.when(late, F.col("events"))).alias("late_events"))
    first = F.col("before") + size
    if max_gap is not None:
        first = F.greatest(first, F.col("through") - (max_gap - 1) * size)
    spans = flushes.filter("through > before").select(
        PARTITION, F.col("poll").alias("emitted_by"), first.alias("first"), F.col("through").alias("last"))
    out = window_grid(spans, size, (PARTITION, "emitted_by"))
    # One row per topic partition.
    ends = F.broadcast(flushes.groupBy(PARTITION).agg(F.max("through").alias("final")))
    status = F.when(F.col("emitted_by").isNotNull(), "emitted").when(F.col("window_start") <= F.col("final"), "dropped").otherwise("open")
    return out.join(taken, [PARTITION, "window_start"], "full").join(ends, PARTITION).select(
        PARTITION, "window_start", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("events", "late_events")], "emitted_by", status.alias("status"))


def emitted_windows(
    events: DataFrame, ts: Column, poll: Column, size: int, grace: float, max_gap: int | None = None,
    polls_per_chunk: int = 10_000,
) -> DataFrame:
    """The windows that were emitted, quiet ones too, and those others that have events on time, with their status."""
    fates = window_fates(events, ts, poll, size, grace, max_gap, polls_per_chunk)
    return fates.filter((F.col("events") > 0) | F.col("emitted_by").isNotNull()).drop("late_events")


def event_fates(
    events: DataFrame, ts: Column, poll: Column, size: int, grace: float, max_gap: int | None = None,
    polls_per_chunk: int = 10_000,
) -> DataFrame:
    """Events per partition by what the flushes made of them: late, emitted, dropped by a gap cap, or open."""
    fates = window_fates(events, ts, poll, size, grace, max_gap, polls_per_chunk)
    return fates.groupBy(PARTITION).agg(F.sum("late_events").alias("late_events"), *[
        F.sum(F.when(F.col("status") == s, F.col("events")).otherwise(0)).alias(f"{s}_events") for s in ("emitted", "dropped", "open")])


def watermark_lag(watermarks: DataFrame, as_of_epoch: int) -> DataFrame:
    """Seconds each partition's watermark is behind ``as_of``."""
    lag = (F.lit(as_of_epoch * 1_000_000) - epoch_micros(F.col("watermark"))) / F.lit(1_000_000.0)
    return watermarks.select(PARTITION, lag.alias("lag_seconds"))
