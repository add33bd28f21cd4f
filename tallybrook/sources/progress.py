"""What a streaming query reports about itself, as tables."""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tallybrook.schemas import SAMPLES
from tallybrook.sources.tables import append_batch, read_table

END, COMMITTED = "topic_end_offset", "topic_committed_offset"


def _partitions(offsets) -> Iterable[tuple[str, int, int]]:
    """The offsets of a source that reads topics; other sources have none per partition."""
    offsets = json.loads(offsets) if isinstance(offsets, str) else offsets or {}
    for topic, partitions in offsets.items():
        if isinstance(partitions, Mapping):
            for partition, offset in partitions.items():
                yield topic, int(partition), int(offset)


def _moment(text: str) -> datetime:
    return datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(timezone.utc)


def progress_samples(report: Mapping) -> list[tuple]:
    """
    One progress report as rows of ``SAMPLES``: rows read, time by step, state and rows behind the watermark,
    the watermark's age, what the query observes, and for topics both ends of what is left to read.
    """
    now, query = _moment(report["timestamp"]), {"query": report.get("name") or report["id"]}
    out = [(now, "stream_batch_rows", query, None, float(report.get("numInputRows") or 0))]
    out += [(now, "stream_step_seconds", {**query, "step": step}, None, ms / 1000.0)
            for step, ms in sorted((report.get("durationMs") or {}).items())]
    if watermark := (report.get("eventTime") or {}).get("watermark"):
        out.append((now, "watermark_lag_seconds", query, None, (now - _moment(watermark)).total_seconds()))
    for k, state in enumerate(report.get("stateOperators") or ()):
        own = {**query, "operator": str(k)}
        out.append((now, "stream_state_rows", own, None, float(state["numRowsTotal"])))
        out.append((now, "stream_rows_behind_watermark", own, None, float(state.get("numRowsDroppedByWatermark") or 0)))
    for name, values in sorted((report.get("observedMetrics") or {}).items()):
        out += [(now, "stream_observed", {**query, "metric": name, "field": field}, None, float(value))
                for field, value in sorted(values.items()) if isinstance(value, (int, float))]
    for source in report.get("sources") or ():
        for metric, offsets in ((END, source.get("latestOffset")), (COMMITTED, source.get("endOffset"))):
            out += [(now, metric, {**query, "topic": topic, "partition": str(partition)}, None, float(offset))
                    for topic, partition, offset in _partitions(offsets)]
    return out


class ProgressTable(StreamingQueryListener):
    """
    Writes every progress report of the session's queries to a table of samples, for the rules and series
    that read them. A report is a few dozen rows.

    ``spark.streams.addListener(ProgressTable(spark, folder))``
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._number = time.time_ns() // 1_000_000

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.write(json.loads(event.progress.json))

    def write(self, report: Mapping) -> None:
        self._number += 1
        rows = self.spark.createDataFrame(progress_samples(report), SAMPLES).coalesce(1)
        append_batch(rows, self.folder, self._number, F.to_date("ts"), date_name="day", order=("metric",))


def read_samples(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, SAMPLES, date_name="day")


def topic_offsets(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """
    End of the log and the next offset to read, per topic partition, by the newest samples; the two inputs of
    ``health.consumer_lag``.
    """
    rows = samples.filter(F.col("metric").isin(END, COMMITTED)).groupBy(
        F.col("labels")["topic"].alias("topic"), F.col("labels")["partition"].cast("int").alias("partition"), "metric").agg(
        F.max_by("value", "ts").cast("long").alias("offset"))
    return tuple(rows.filter(F.col("metric") == metric).select("topic", "partition", F.col("offset").alias(name))
                 for metric, name in ((END, "end_offset"), (COMMITTED, "committed")))
