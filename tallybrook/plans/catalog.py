"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.functions.clock import epoch_of, epoch_seconds, window_start
from tallybrook.functions.display import console_line, status_band
from tallybrook.functions.packing import counts_text
from tallybrook.operators import health, lateness, rules, series, windows
from tallybrook.operators.exact_editors import count_editors, editor_bitmaps, number_editors
from tallybrook.operators.rollup import (
    distinct_editors, rollup_day, rollup_minute, rollup_read, with_estimates,
)
from tallybrook.plans import analytics
from tallybrook.session import shared_folder
from tallybrook.settings import MAX_GAP_WINDOWS, RANGES
from tallybrook.sources import messages as wire
from tallybrook.schemas import SAMPLES
from tallybrook.sources.event_log import load_edits, load_messages, redelivered
from tallybrook.sources.samples import path_samples
from tallybrook.sources.tables import append_batch, dedup, expired, read_table
from tallybrook.streaming.live import newest_slices, read_slices, write_slices
from tallybrook.streaming.stored import StoredTables, store_batch

AS_OF = "2024-01-31 00:00:00"
RESET_AT = "2024-01-15 00:00:00"
SIZE = 300
GRACE = 60
POLL = 600
DAY = 86_400
SCRAPE = 300
DELAY_BOUNDS = (60, 300, 600, 1200, 1800, 3600, 7200, 14400)
LATENESS_BOUNDS = (60, 180, 300, 420, 540, 660)
COMMIT_EVERY = 5_000
STEPS = ((None, "green"), (300, "yellow"), (600, "red"))
# The pipeline's rules are made for samples some seconds apart; here a scrape is as far apart as theirs, times 60.
SLOWER = 60
EVALUATE = 1_800

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def arrival() -> Column:
    return F.col("ingested_at")


def payload() -> Column:
    return F.col("event_time")


def poll() -> Column:
    return F.floor(epoch_seconds(arrival()) / POLL)


_written: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, folder: str, name: str, write: Callable[[str], None]) -> str:
    """
    The folder of a table that queries read as stored, written once per session and input: what a
    streaming path would have left there.
    """
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _written:
        path = f"{shared_folder(spark, 'queries')}/{name}-{uuid4().hex}"
        write(path)
        _written[key] = path
    return _written[key]


def recent_rollup(spark: SparkSession, folder: str, range_: str) -> DataFrame:
    """The minute rollup of the whole days a range touches; the bound prunes the raw scan too."""
    edits = load_edits(spark, folder)
    return rollup_minute(analytics.since_day(edits, "ingested_at", RANGES[range_], AS_OF))


# -- ingest -------------------------------------------------------------------

@query
def events_project(spark, folder):
    return wire.project(load_messages(spark, folder), keep=("offset",))


@query
def events_dropped_by_reason(spark, folder):
    return wire.dropped_by_reason(load_messages(spark, folder))


@query
def events_parse(spark, folder):
    return wire.judged(load_messages(spark, folder)).select("partition", "offset", "error", "event.*")


@query
def events_clean(spark, folder):
    return wire.clean_rows(wire.judged(load_messages(spark, folder)))


@query
def events_dead_letter(spark, folder):
    return wire.dead_letters(wire.judged(load_messages(spark, folder)), as_of())


@query
def events_publish(spark, folder):
    return wire.keyed(wire.project(load_messages(spark, folder)))


@query
def edits_dedup(spark, folder):
    copies = redelivered(load_edits(spark, folder))
    return dedup(copies).select(
        "ingested_at", "wiki", "type", "user", "bot", "kafka_partition", "kafka_offset"
    )


@query
def retention_cutoff(spark, folder):
    edits = load_edits(spark, folder)
    minute = rollup_minute(edits)
    errors = wire.dead_letters(wire.judged(load_messages(spark, folder)), F.col("timestamp"))
    tables = [
        ("edits", edits, "ingested_at", 7),
        ("edits_errors", errors, "seen_at", 30),
        ("edits_1m", minute, "minute", 90),
        ("edits_1d", rollup_day(minute), "day", None),
    ]
    out = None
    for name, df, column, days in tables:
        gone = expired(df, column, days, AS_OF)
        counts = df.agg(
            F.lit(name).alias("table_name"),
            F.count_if(~gone).alias("kept"),
            F.count_if(gone).alias("dropped"),
        )
        out = counts if out is None else out.unionByName(counts)
    return out


# -- filters and placeholders -------------------------------------------------

@query
def range_filter(spark, folder):
    rows = analytics.since(load_edits(spark, folder), "ingested_at", RANGES["7d"], AS_OF)
    return rows.select("kafka_partition", "kafka_offset", "ingested_at", "wiki")


@query
def recent_partitions(spark, folder):
    rows = analytics.recent_days(load_edits(spark, folder), "ingested_at", AS_OF)
    return rows.select("kafka_partition", "kafka_offset", "ingested_at")


@query
def edits_normalized(spark, folder):
    return windows.normalize(load_edits(spark, folder)).select(
        "kafka_offset", "wiki", "type", "user", "bot"
    )


@query
def event_clock(spark, folder):
    rows = wire.clean_rows(wire.judged(load_messages(spark, folder)))
    return rows.select("kafka_offset", windows.event_clock(rows, "event").alias("clock"))


@query
def window_assign(spark, folder):
    rows = windows.assign_window(load_edits(spark, folder), payload(), 5)
    return rows.select("kafka_offset", "window_start", "window_end")


# -- rollups ------------------------------------------------------------------

@query
def rollup_1m(spark, folder):
    return with_estimates(rollup_minute(load_edits(spark, folder)))


@query
def rollup_1d(spark, folder):
    return with_estimates(rollup_day(rollup_minute(load_edits(spark, folder))))


@query
def rollup_read_parts(spark, folder):
    parts = rollup_minute(load_edits(spark, folder), "type").drop("type")
    return with_estimates(rollup_read(parts, ["minute", "wiki"]))


@query
def rollup_redelivered(spark, folder):
    return with_estimates(rollup_day(rollup_minute(redelivered(load_edits(spark, folder)))))


@query
def editors_distinct(spark, folder):
    return distinct_editors(load_edits(spark, folder), "wiki")


@query
def rollup_1d_exact(spark, folder):
    """Editors per day and wiki, exact at any number, from bitmaps of numbered editors."""
    edits = load_edits(spark, folder)
    nobody = spark.createDataFrame([], "user string, number long")
    days = editor_bitmaps(edits, number_editors(edits, nobody), F.to_date("ingested_at").alias("day"), "wiki")
    return count_editors(days, ["day", "wiki"])


# -- analytics ----------------------------------------------------------------

def _timeline(spark, folder, range_, bucket):
    minute = recent_rollup(spark, folder, range_)
    return analytics.timeline(minute, rollup_day(minute), range_, bucket, AS_OF)


@query
def timeline_1m(spark, folder):
    return _timeline(spark, folder, "24h", "1m")


@query
def timeline_5m(spark, folder):
    return _timeline(spark, folder, "24h", "5m")


@query
def timeline_1h(spark, folder):
    return _timeline(spark, folder, "7d", "1h")


@query
def timeline_1d(spark, folder):
    return _timeline(spark, folder, "30d", "1d")


@query
def timeline_grid(spark, folder):
    return analytics.timeline_grid(_timeline(spark, folder, "24h", "5m"), "24h", "5m", AS_OF)


@query
def timeline_rates(spark, folder):
    points = _timeline(spark, folder, "7d", "1h")
    return analytics.timeline_rates(analytics.timeline_grid(points, "7d", "1h", AS_OF), "1h")


@query
def timeline_rates_shown(spark, folder):
    points = _timeline(spark, folder, "7d", "1h")
    return analytics.timeline_rates(analytics.timeline_grid(points, "7d", "1h", AS_OF), "1h", shown=True)


@query
def top_wikis(spark, folder):
    return analytics.top_wikis(recent_rollup(spark, folder, "30d"), "30d", 10, AS_OF)


@query
def top_editors(spark, folder):
    # Copies come a second after their original, so the raw scan may be cut a second earlier.
    recent = analytics.since(load_edits(spark, folder), "ingested_at", RANGES["7d"] + 1, AS_OF)
    return analytics.top_editors(redelivered(recent), "7d", 10, AS_OF)


@query
def freshness(spark, folder):
    return analytics.freshness(load_edits(spark, folder), AS_OF)


@query
def range_tiles(spark, folder):
    minute = recent_rollup(spark, folder, "7d")
    return analytics.range_tiles(
        analytics.timeline(minute, rollup_day(minute), "7d", "1h", AS_OF),
        analytics.top_wikis(minute, "7d", 10, AS_OF),
    )


@query
def history_tiles(spark, folder):
    return analytics.history_tiles(recent_rollup(spark, folder, "90d"), AS_OF)


# -- stored tables ------------------------------------------------------------

def _stored(spark, folder) -> StoredTables:
    """The tables as the stored path writes them: all messages, in one batch up to ``RESET_AT`` and one after it."""
    def write(path: str) -> None:
        messages, tables = load_messages(spark, folder), StoredTables(spark, path)
        for batch, part in enumerate((F.col("timestamp") < F.lit(RESET_AT), F.col("timestamp") >= F.lit(RESET_AT))):
            store_batch(wire.judged(messages.filter(part)).withColumn("seen_at", as_of()), batch, tables, exact_editors=True)

    return StoredTables(spark, written(spark, folder, "stored", write))


def _slices_folder(spark, folder, clock: str) -> str:
    """Slices by ``clock`` as the live path leaves them, written when the last of their edits came in."""
    def write(path: str) -> None:
        edits = load_edits(spark, folder)
        complete = edits.groupBy(window_start(F.col(clock), SIZE).alias("window_start"), F.col("kafka_partition").alias("partition")).agg(
            F.max("ingested_at").cast("timestamp").alias("written_at"))
        write_slices(windows.window_slices(edits, F.col(clock), SIZE).join(complete, ["window_start", "partition"]), path, 0)

    return written(spark, folder, f"slices-{clock}", write)


def _stored_slices(spark, folder, clock: str, since: str) -> DataFrame:
    return read_slices(spark, _slices_folder(spark, folder, clock), since)


@query
def stored_timeline_1h(spark, folder):
    tables = _stored(spark, folder)
    return analytics.timeline(tables.minute_parts(), tables.day_parts(), "7d", "1h", AS_OF)


@query
def stored_top_wikis(spark, folder):
    return analytics.top_wikis(_stored(spark, folder).minute_parts(), "30d", 10, AS_OF)


@query
def stored_window_latest(spark, folder):
    newest = newest_slices(spark, _slices_folder(spark, folder, "ingested_at"), 1)
    return _flat(windows.merge_slices(newest), "partitions").drop("top_editors")


@query
def stored_editors(spark, folder):
    """Distinct editors of each wiki over the whole table, merged from the bitmaps of days and batches."""
    return count_editors(_stored(spark, folder).day_editors(), ["wiki"])


@query
def stored_editors_7d(spark, folder):
    days = analytics.since_day(_stored(spark, folder).day_editors(), "day_date", RANGES["7d"], AS_OF)
    return count_editors(days, ["wiki"])


@query
def stored_batches(spark, folder):
    return _stored(spark, folder).batches().select(
        "batch_id", "kafka_partition", "low", "high", "messages", F.col("newest").cast("timestamp_ntz").alias("newest"))


# -- windows ------------------------------------------------------------------

def _slices(spark, folder, size=SIZE):
    return windows.window_slices(load_edits(spark, folder), arrival(), size)


def _flat(summaries: DataFrame, *extra: str) -> DataFrame:
    return summaries.select(
        "window_start",
        "window_end",
        "total_edits",
        "edits_per_second",
        counts_text(F.col("edits_per_wiki")).alias("edits_per_wiki"),
        F.col("bot_vs_human.bot").alias("bot"),
        F.col("bot_vs_human.human").alias("human"),
        counts_text(F.col("edit_types")).alias("edit_types"),
        counts_text(F.col("top_editors"), "user").alias("top_editors"),
        *extra,
    )


@query
def window_summary(spark, folder):
    return _flat(_slices(spark, folder), "partition")


@query
def window_merged(spark, folder):
    return _flat(windows.window_summaries(load_edits(spark, folder), arrival(), SIZE), "partitions")


@query
def window_points(spark, folder):
    return windows.window_points(_slices(spark, folder))


@query
def window_latest(spark, folder):
    newest = windows.newest_events(load_edits(spark, folder), "ingested_at", SIZE)
    return _flat(windows.window_summaries(newest, arrival(), SIZE), "partitions")


@query
def window_history(spark, folder):
    newest = newest_slices(spark, _slices_folder(spark, folder, "ingested_at"), 60)
    return windows.window_history(newest, 60)


@query
def window_trim(spark, folder):
    newest = newest_slices(spark, _slices_folder(spark, folder, "ingested_at"), 120)
    return newest.select("window_start", "partition", "total_edits")


@query
def window_ttl(spark, folder):
    slices = _stored_slices(spark, folder, "event_time", "2024-01-01")
    return windows.within_ttl(slices, epoch_seconds(F.col("written_at")), epoch_of(AS_OF), DAY).select(
        "window_start", "partition", "total_edits", F.col("written_at").cast("timestamp_ntz").alias("written_at"))


@query
def window_point_rates(spark, folder):
    return windows.point_rates(windows.window_points(_slices(spark, folder)))


@query
def window_view(spark, folder):
    view = windows.window_view(windows.merge_slices(_slices(spark, folder, DAY)))
    return view.withColumn("wikis", F.array_join(F.transform(
        "wikis", lambda w: F.concat_ws("=", w["wiki"], w["count"].cast("string"),
                                       F.round(w["bar_percent"], 3).cast("decimal(6,3)").cast("string"))), ","))


@query
def window_top_editors(spark, folder):
    return windows.window_top_editors(load_edits(spark, folder), arrival(), DAY)


@query
def window_top_editors_slices(spark, folder):
    return windows.window_top_editors_from_slices(load_edits(spark, folder), arrival(), DAY)


@query
def window_top_editors_merged(spark, folder):
    """From mergeable states of each partition, written as a table and read back."""
    def write(path: str) -> None:
        windows.editor_states(load_edits(spark, folder), arrival(), DAY).write.parquet(path)

    return windows.merged_top_editors(spark.read.parquet(written(spark, folder, "editor-states", write)))


@query
def window_upsert(spark, folder):
    # Version 1 is what was there before the error events came in, version 2 the rewrite.
    versions = F.when(F.col("type") == "error", F.array(F.lit(2))).otherwise(F.array(F.lit(1), F.lit(2)))
    written = (
        load_edits(spark, folder)
        .withColumn("version", F.explode(versions))
        .groupBy(
            window_start(arrival(), SIZE).alias("window_start"),
            F.col("kafka_partition").alias("partition"),
            "version",
        )
        .agg(F.count("*").alias("total"), F.count_if(F.col("bot")).alias("bots"))
    )
    return windows.latest_version(written, ["window_start", "partition"])


@query
def window_changes(spark, folder):
    seen = (
        load_edits(spark, folder)
        .groupBy(window_start(payload(), SIZE).alias("window_start"), poll().alias("version"))
        .agg(F.count("*").alias("n"))
    )
    # One row per window and poll that touched it.
    so_far = Window.partitionBy("window_start").orderBy("version")
    totals = seen.select("window_start", "version", F.sum("n").over(so_far).alias("total"))
    return windows.window_changes(totals)


@query
def window_console_line(spark, folder):
    merged = windows.merge_slices(_slices(spark, folder, 5))
    line = console_line(
        F.col("window_start"), F.col("total_edits"), F.col("edits_per_second"),
        F.col("edits_per_wiki"), F.col("bot_vs_human.bot"), F.col("bot_vs_human.human"),
    )
    return merged.select("window_start", line.alias("line"))


@query
def window_breakdowns(spark, folder):
    merged = windows.merge_slices(_slices(spark, folder))
    return merged.agg(F.count("*").alias("windows"), F.sum("total_edits").alias("edits"),
                      F.count_if(windows.adds_up()).alias("consistent"))


# -- lateness -----------------------------------------------------------------

def _counts(edits: DataFrame, ts: Column) -> DataFrame:
    return edits.groupBy("kafka_partition", window_start(ts, SIZE).alias("window_start")).agg(
        F.count("*").alias("events")
    )


@query
def partition_watermark(spark, folder):
    return lateness.partition_watermark(load_edits(spark, folder), payload())


@query
def running_watermark(spark, folder):
    rows = lateness.running_watermark(load_edits(spark, folder), payload())
    return rows.select("kafka_partition", "kafka_offset", "before_us", "watermark_us")


@query
def watermark_lag(spark, folder):
    marks = lateness.partition_watermark(load_edits(spark, folder), payload())
    return lateness.watermark_lag(marks, epoch_of(AS_OF))


@query
def late_events(spark, folder):
    rows = lateness.late_events(load_edits(spark, folder), payload(), SIZE, GRACE)
    return rows.select("kafka_partition", "kafka_offset", "window_start")


@query
def late_disposition(spark, folder):
    """Events by what the flush after each poll made of them."""
    return lateness.event_fates(load_edits(spark, folder), payload(), poll(), SIZE, GRACE)


@query
def closed_disposition(spark, folder):
    """Events by what the watermark before and after them says, row by row."""
    return lateness.disposition(load_edits(spark, folder), payload(), SIZE, GRACE)


@query
def window_origin(spark, folder):
    rows = lateness.apply_origin(load_edits(spark, folder), payload(), SIZE)
    return rows.select("kafka_partition", "kafka_offset", "window_start", "origin", "before_origin")


@query
def window_closed(spark, folder):
    edits = load_edits(spark, folder)
    return lateness.closed_windows(
        _counts(edits, payload()), lateness.partition_watermark(edits, payload()), SIZE, GRACE
    )


@query
def window_dense(spark, folder):
    return lateness.densify(_counts(load_edits(spark, folder), arrival()), SIZE)


@query
def window_gaps_filled(spark, folder):
    return lateness.fill_gaps(_counts(load_edits(spark, folder), arrival()), SIZE).drop("skipped")


@query
def window_gaps_skipped(spark, folder):
    return lateness.fill_gaps(_counts(load_edits(spark, folder), arrival()), SIZE, MAX_GAP_WINDOWS)


@query
def window_gap_capped(spark, folder):
    """Every window as the flush after each poll leaves it, where a flush emits no more than the newest windows."""
    return lateness.emitted_windows(load_edits(spark, folder), payload(), poll(), SIZE, GRACE, MAX_GAP_WINDOWS)


def _delays(spark, folder):
    """Delays of all windows that were emitted, quiet ones too; a flush ends with its poll."""
    out = lateness.emitted_windows(load_edits(spark, folder), payload(), poll(), SIZE, GRACE).filter("status = 'emitted'")
    return health.emit_delay(out.withColumn("written_at", (F.col("emitted_by") + 1) * POLL), SIZE)


@query
def emit_delay(spark, folder):
    return _delays(spark, folder).select("kafka_partition", "window_start", "written_at", "delay_seconds")


@query
def slice_delay(spark, folder):
    return health.slice_delays(_stored_slices(spark, folder, "event_time", "2024-01-01"))


@query
def restart_offsets(spark, folder):
    return lateness.restart_offsets(load_edits(spark, folder), payload(), SIZE, GRACE)


# -- checks -------------------------------------------------------------------

@query
def cold_path_health(spark, folder):
    judged = wire.judged(load_messages(spark, folder))
    return health.cold_path_health(
        wire.clean_rows(judged), wire.dead_letters(judged, as_of()), AS_OF,
        grown_since="2024-01-30 23:00:00",
    )


@query
def live_path_health(spark, folder):
    return health.live_path_health(_slices(spark, folder), epoch_of(AS_OF))


@query
def reconcile_hot_cold(spark, folder):
    edits = load_edits(spark, folder)
    live = _counts(edits, arrival()).withColumnRenamed("events", "total")
    return health.reconcile_hot_cold(live, rollup_minute(redelivered(edits)), SIZE)


# -- health series ------------------------------------------------------------

def load_samples(spark, folder) -> DataFrame:
    """The samples that a monitor of the table of edits would have written."""
    def write(path: str) -> None:
        found = path_samples(load_edits(spark, folder), SCRAPE, epoch_of(RESET_AT), LATENESS_BOUNDS, COMMIT_EVERY)
        append_batch(found.withColumn("ts", F.col("ts").cast("timestamp")), path, 0, F.to_date("ts"), date_name="day", order=("metric", "ts"))

    return read_table(spark, written(spark, folder, "samples", write), SAMPLES, date_name="day")


def _metric(spark, folder, name):
    return load_samples(spark, folder).filter(F.col("metric") == name)


@query
def counter_rate(spark, folder):
    return series.counter_rate(_metric(spark, folder, "events_consumed_total"), 3600, ["partition"])


@query
def counter_rate_rolling(spark, folder):
    steps = series.counter_rate(_metric(spark, folder, "events_consumed_total"), SCRAPE)
    return series.rolling_rate(steps, ["metric"], 3600).select("metric", "t", "rate")


@query
def gauge_by_label(spark, folder):
    return series.gauge_by_label(_metric(spark, folder, "watermark_lag_seconds"), "max", "partition", 3600)


@query
def gauge_total(spark, folder):
    return series.gauge_by_label(_metric(spark, folder, "watermark_lag_seconds"), "sum", None, 3600)


@query
def histogram_buckets(spark, folder):
    return series.observe(_delays(spark, folder), "delay_seconds", DELAY_BOUNDS, ["kafka_partition"])


@query
def histogram_quantile(spark, folder):
    buckets = series.observe(_delays(spark, folder), "delay_seconds", DELAY_BOUNDS, ["kafka_partition"])
    return series.histogram_quantile(buckets, 0.99, ["kafka_partition"], "p99")


@query
def consumer_lag(spark, folder):
    """How far the stored path was behind the end of the log after its first batch."""
    messages = load_messages(spark, folder)
    ends = messages.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))
    done = _stored(spark, folder).batches().filter("batch_id = 0").select(
        F.col("kafka_partition").alias("partition"), (F.col("high") + 1).alias("committed"))
    return health.consumer_lag(ends, done)


@query
def rate_quantile(spark, folder):
    """The 99th percentile of the lateness of the edits of the last hours, at each evaluation and partition."""
    late = rules.Expression("emit_delay_seconds_bucket", "rate", 6 * 3600, "sum", ("partition",), 0.99)
    return rules.evaluate(load_samples(spark, folder), {"p99": late}, *_grid()).drop("name")


@query
def status_bands(spark, folder):
    lag = series.gauge_by_label(_metric(spark, folder, "watermark_lag_seconds"), "max", "partition", SCRAPE)
    return lag.select("label", "t", "value", status_band(F.col("value"), STEPS).alias("band"))


def _grid() -> tuple[int, int, int]:
    return epoch_of("2023-12-31 00:00:00"), epoch_of(AS_OF), EVALUATE


@query
def rule_values(spark, folder):
    expressions = {r.alert: r.scaled(SLOWER).expression for r in rules.ALERT_RULES}
    return rules.evaluate(load_samples(spark, folder), expressions, *_grid())


@query
def alert_states(spark, folder):
    scaled = [r.scaled(SLOWER) for r in rules.ALERT_RULES]
    return rules.alert_states(load_samples(spark, folder), scaled, *_grid())
