"""
Alert rules over a table of metric samples, all of them in one plan with one scan.

An ``Expression`` reads one metric at every step of an evaluation grid. Each sample is sent to the
expressions that read it and from there to the steps that see it: a gauge's until it is too old, a
counter's growth as long as both of its samples lie in the window. So trailing windows are
plain sums of partial aggregates; only the sample before has to be known, which is looked for
within a day's chunk of a series and the window before it.

A rule holds where its expression passes a threshold or, with ``absent``, where its metric has no recent
sample at all. It fires once it has held at every step of its duration, which is a count as well:
each step at which it holds is counted for the steps that look back on it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallybrook.functions.clock import epoch_micros
from tallybrook.operators.series import bucket_quantile, series_key

DAY = 86_400
SECOND = 1_000_000
#: Seconds for which a sample stands for its series.
FRESH = 300
READINGS = ("value", "rate", "increase")


@dataclass(frozen=True)
class Expression:
    """
    ``reading`` of ``metric`` over the trailing ``window`` seconds, of the series whose labels are
    ``matching``; with ``total`` (sum or max) over all series that share the ``by`` labels, and with
    ``quantile`` of the histogram that these form by their bounds.
    """

    metric: str
    reading: str = "value"
    window: int = FRESH
    total: str | None = None
    by: tuple[str, ...] = ()
    quantile: float | None = None
    matching: tuple[tuple[str, str], ...] = ()

    def __post_init__(self):
        if self.reading not in READINGS or self.total not in (None, "sum", "max") or self.window <= 0:
            raise ValueError(f"unsupported expression {self}")
        if self.quantile is not None and (self.total != "sum" or not 0 <= self.quantile <= 1):
            raise ValueError(f"a quantile between 0 and 1 is taken of a sum, not of {self}")


@dataclass(frozen=True)
class Rule:
    """``expression <comparison> threshold``, or no recent sample where ``absent``, for ``for_seconds``."""

    alert: str
    expression: Expression
    comparison: str
    threshold: float
    for_seconds: int
    severity: str
    absent: bool = False
    fresh: int = FRESH

    def scaled(self, factor: int) -> Rule:
        """The same rule with all its times ``factor`` times as long."""
        longer = replace(self.expression, window=self.expression.window * factor)
        return replace(self, expression=longer, for_seconds=self.for_seconds * factor, fresh=self.fresh * factor)

    def holds(self, value: Column) -> Column:
        limit = F.lit(float(self.threshold))
        tests = {"==": value == limit, ">": value > limit, ">=": value >= limit, "<": value < limit, "<=": value <= limit}
        return tests[self.comparison]


def _rate(metric: str, window: int) -> Expression:
    return Expression(metric, "rate", window, "sum")


# The rules of the pipeline.
ALERT_RULES = (
    Rule("TargetDown", Expression("up"), "==", 0, 60, "critical"),
    Rule("PipelineStalled", _rate("windows_emitted_total", 60), "==", 0, 120, "critical", absent=True),
    Rule("NoEventsProduced", _rate("events_produced_total", 60), "==", 0, 120, "critical", absent=True),
    Rule("ConsumerLagHigh", Expression("consumer_lag", total="sum", matching=(("group", "live"),)), ">", 2000, 120, "warning"),
    Rule("FreshnessSLOBreached", Expression("emit_delay_seconds_bucket", "rate", 300, "sum", quantile=0.99), ">", 2.5, 300, "warning"),
    Rule("ProduceErrors", Expression("produce_errors_total", "increase", 300), ">", 0, 0, "critical"),
    Rule("SinkErrors", Expression("sink_errors_total", "increase", 300), ">", 0, 0, "warning"),
    Rule("EventsDropped", _rate("events_dropped_total", 300), ">", 1, 600, "warning"),
)


def _readers(expressions: Mapping[str, Expression]) -> Column:
    """The expressions that read a sample, with the labels it goes under in each."""
    readers = []
    for name, e in expressions.items():
        reads = F.col("metric") == e.metric
        for label, value in e.matching:
            reads &= F.col("labels")[label] == value
        kept = F.map_filter("labels", lambda k, _: k.isin(list(e.by))) if e.by else None
        group = F.col("series") if e.total is None else F.lit("") if kept is None else series_key(kept)
        readers.append(F.when(reads, F.struct(
            F.lit(name).alias("name"), F.lit(e.reading).alias("reading"), F.lit(e.window * SECOND).alias("window"),
            F.lit(e.total or "sum").alias("total"), F.lit(e.quantile).cast("double").alias("quantile"), group.alias("labels"))))
    return F.filter(F.array(*readers), lambda r: r.isNotNull())


def evaluate(samples: DataFrame, expressions: Mapping[str, Expression], start: int, end: int, step: int) -> DataFrame:
    """
    ``name, labels, t, value`` of each of the named expressions at each ``step`` from ``start`` to ``end``
    (epoch seconds) at which it has a value.

    Growth over a window is that between its first and its last sample, so it takes two of them; it is not
    stretched to the window's edges. A counter that went down started anew at zero.
    """
    metrics = sorted({e.metric for e in expressions.values()})
    rows = samples.filter(F.col("metric").isin(metrics)).withColumn("series", series_key(F.col("labels")))
    rows = rows.select("series", "le", "value", epoch_micros(F.col("ts")).alias("at"), F.explode(_readers(expressions)).alias("e"))
    rows = rows.select("series", "le", "value", "at", "e.*").withColumn("grows", F.col("reading") != "value")
    # The next chunk looks back on the samples from its start less the window on.
    length = max(DAY, *(e.window for e in expressions.values())) * SECOND
    chunk = F.floor(F.col("at") / length)
    reaches = F.col("grows") & (F.col("at") > (chunk + 1) * length - F.col("window"))
    dealt = rows.withColumn("own", chunk).withColumn(
        "chunk", F.explode(F.when(reaches, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))))
    before = Window.partitionBy("name", "series", "le", "chunk").orderBy("at", "value")
    dealt = dealt.withColumns({"last_at": F.lag("at").over(before), "last": F.lag("value").over(before)}).filter("own = chunk")
    grown = F.when(F.col("value") < F.col("last"), F.col("value")).otherwise(F.col("value") - F.col("last"))
    # A sample is seen from its own time on, growth for as long as the sample before is in the window.
    until = F.when(F.col("grows"), F.col("last_at")).otherwise(F.col("at")) + F.col("window")

    def index(moment: Column) -> Column:
        return F.ceil((moment - F.lit(start * SECOND)) / F.lit(step * SECOND))

    first = F.greatest(F.lit(0).cast("long"), index(F.col("at")))
    last = F.least(F.lit((end - start) // step).cast("long"), index(until) - 1)
    seen = dealt.withColumns({"first": first, "last_seen": last}).filter("first <= last_seen").withColumn(
        "t", F.explode(F.transform(F.sequence("first", "last_seen"), lambda k: k * step + start)))
    reader = ["name", "reading", "window", "total", "quantile", "labels"]
    by_series = seen.groupBy(*reader, "series", "le", "t").agg(
        F.max_by("value", F.struct("at", "value")).alias("newest"), F.sum(grown).alias("growth"))
    own = F.when(F.col("reading") == "value", F.col("newest")).otherwise(F.col("growth"))
    totals = by_series.withColumn("own", own).groupBy(*reader, "le", "t").agg(F.sum("own").alias("sum"), F.max("own").alias("max"))
    totals = totals.withColumn("own", F.when(F.col("total") == "max", F.col("max")).otherwise(F.col("sum")))
    bounds = totals.groupBy(*reader, "t").agg(F.sort_array(F.collect_list(F.struct("le", F.col("own").alias("cumulative")))).alias("buckets"))
    plain = F.col("buckets")[0]["cumulative"]
    value = F.when(F.col("quantile").isNotNull(), bucket_quantile(F.col("buckets"), F.col("quantile"))).when(
        F.col("reading") == "rate", plain / (F.col("window") / SECOND)).otherwise(plain)
    return bounds.select("name", "labels", "t", value.alias("value")).filter("value is not null")


def alert_states(samples: DataFrame, rules: Sequence[Rule], start: int, end: int, step: int) -> DataFrame:
    """
    ``alert, severity, labels, t, value, state`` of each rule at each step at which its expression has a value
    or it holds without one: inactive, pending, or firing once it has held for its duration.
    """
    expressions = {r.alert: r.expression for r in rules}
    present = {f"{r.alert}/present": Expression(r.expression.metric, window=r.fresh, total="max") for r in rules if r.absent}
    values = evaluate(samples, {**expressions, **present}, start, end, step)
    parts = F.split("name", "/")
    told = values.select(parts[0].alias("alert"), "labels", "t", F.when(F.size(parts) == 1, F.col("value")).alias("value"),
                         (F.size(parts) > 1).alias("present"))
    steps = samples.sparkSession.range(start, end + 1, step).select(
        F.explode(F.array(*[F.lit(r.alert) for r in rules if r.absent]).cast("array<string>")).alias("alert"), F.lit("").alias("labels"),
        F.col("id").alias("t"), F.lit(None).cast("double").alias("value"), F.lit(False).alias("present"))
    every = told.unionByName(steps).groupBy("alert", "labels", "t").agg(F.max("value").alias("value"), F.max("present").alias("present"))
    active, look_back, severity = F.lit(False), F.lit(0), F.lit("")
    for r in rules:
        here = F.col("alert") == r.alert
        holds = F.coalesce(r.holds(F.col("value")), F.lit(False))
        active = F.when(here, holds | ~F.col("present") if r.absent else holds).otherwise(active)
        look_back = F.when(here, ceil(r.for_seconds / step)).otherwise(look_back)
        severity = F.when(here, r.severity).otherwise(severity)
    every = every.withColumns({"active": active, "steps": look_back}).filter("value is not null or active")
    # Each step that holds counts for itself and for the steps whose duration reaches back to it.
    counted = every.withColumn("later", F.explode(F.when(F.col("active"), F.sequence(F.lit(0), F.col("steps"))).otherwise(F.array(F.lit(0)))))
    itself = F.col("later") == 0
    judged = counted.groupBy("alert", "labels", "steps", (F.col("t") + F.col("later") * step).alias("t")).agg(
        F.max(itself).alias("itself"), F.max(F.when(itself, F.col("active"))).alias("active"),
        F.max(F.when(itself, F.col("value"))).alias("value"), F.count_if(F.col("active")).alias("held")).filter("itself")
    state = F.when(~F.col("active"), "inactive").when(F.col("held") > F.col("steps"), "firing").otherwise("pending")
    return judged.select("alert", severity.alias("severity"), "labels", "t", "value", state.alias("state"))
