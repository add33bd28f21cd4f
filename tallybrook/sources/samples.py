"""Metric samples, from what the engine's tables say about the paths that filled them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.clock import epoch_seconds, window_start
from tallybrook.operators.ordered import running_sum

DAY = 86_400


def scrapes(edits: DataFrame, every: int, counts: Mapping[str, Column]) -> DataFrame:
    """
    One row per partition and interval of ``every`` seconds in which it had edits: ``at``, the end of the
    interval, and for each of ``counts`` its sum over the interval; the newest edit's clock and offset.
    """
    return edits.groupBy("kafka_partition", window_start(F.col("ingested_at"), every).alias("t")).agg(
        F.max("event_time").alias("newest"), F.max("kafka_offset").alias("newest_offset"),
        *[F.sum(c).cast("double").alias(name) for name, c in counts.items()]).withColumn("at", F.col("t") + every).drop("t")


def counters(scraped: DataFrame, names: Sequence[str], restarts: Column) -> DataFrame:
    """
    The sums of ``scraped`` as counters that go up from scrape to scrape, from zero again where ``restarts``
    changes. A partition's scrapes are added up in chunks of a day.
    """
    runs = scraped.withColumn("run", restarts)
    return running_sum(runs, ["kafka_partition", "run"], "at", names, F.floor(F.col("at") / DAY)).drop("run")


def samples(rows: DataFrame, ts: Column, values: Sequence[tuple[str, Mapping[str, Column], float | None, Column]]) -> DataFrame:
    """Rows of ``SAMPLES``: for each row one of each of ``values``, (metric, labels, bound, value), in one pass."""
    def one(metric: str, labels: Mapping[str, Column], le: float | None, value: Column) -> Column:
        pairs = [x for name, label in labels.items() for x in (F.lit(name), label.cast("string"))]
        return F.struct(F.lit(metric).alias("metric"), F.create_map(*pairs).alias("labels"),
                        F.lit(le).cast("double").alias("le"), value.cast("double").alias("value"))

    return rows.select(ts.alias("ts"), F.explode(F.array(*[one(*v) for v in values])).alias("s")).select(
        "ts", "s.metric", "s.labels", "s.le", "s.value")


def path_samples(edits: DataFrame, every: int, restart_at: int, bounds: Sequence[float], commit_every: int) -> DataFrame:
    """
    What a monitor that looks at the table of edits every ``every`` seconds sees of each partition: how many
    were consumed, produced, dropped and failed, how many intervals were filled, delays between an
    edit's own clock and its arrival as a histogram, how far the newest clock and the last commit are back, and whether it
    is up (fewer errors than other edits). Counters start anew at ``restart_at``.
    """
    failed, dropped = F.col("type") == "error", F.col("type") == "click"
    delay = epoch_seconds(F.col("ingested_at")) - epoch_seconds(F.col("event_time"))
    edges = [*map(float, bounds), float("inf")]
    sums = {
        "consumed": F.lit(1), "failed": F.when(failed, 1).otherwise(0), "failed_bots": F.when(failed & F.col("bot"), 1).otherwise(0),
        "dropped": F.when(dropped, 1).otherwise(0),
        **{f"le{k}": F.when(delay <= edge, 1).otherwise(0) for k, edge in enumerate(edges)},
    }
    up = F.when(2 * F.col("failed") >= F.col("consumed"), 0).otherwise(1)
    scraped = scrapes(edits, every, sums).withColumns({"up": up, "windows": F.lit(1.0)})
    rows = counters(scraped, ["windows", *sums], F.col("at") > restart_at)
    own = {"partition": F.col("kafka_partition")}
    return samples(rows, F.timestamp_seconds("at").cast("timestamp_ntz"), [
        ("events_consumed_total", own, None, F.col("consumed")),
        ("events_produced_total", own, None, F.col("consumed") - F.col("failed")),
        ("windows_emitted_total", own, None, F.col("windows")),
        ("produce_errors_total", own, None, F.col("failed")),
        ("sink_errors_total", own, None, F.col("failed_bots")),
        ("events_dropped_total", {**own, "reason": F.lit("invalid")}, None, F.col("dropped")),
        ("up", own, None, F.col("up")),
        ("consumer_lag", {**own, "group": F.lit("live")}, None, F.pmod("newest_offset", F.lit(commit_every))),
        ("watermark_lag_seconds", own, None, F.col("at") - epoch_seconds(F.col("newest"))),
        *[("emit_delay_seconds_bucket", own, edge, F.col(f"le{k}")) for k, edge in enumerate(edges)],
    ])
