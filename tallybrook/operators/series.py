"""Counters, gauges and histograms over a table of metric samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.functions.clock import epoch_seconds, window_start
from tallybrook.operators.ordered import previous

DAY = 86_400


def series_key(labels: Column) -> Column:
    """A label map as text in label order, so that a series can be grouped by it."""
    pairs = F.transform(
        F.array_sort(F.map_entries(labels)), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return F.coalesce(F.array_join(pairs, ","), F.lit(""))


# -- counters -----------------------------------------------------------------

def counter_deltas(samples: DataFrame) -> DataFrame:
    """
    Growth since the sample before, per series. A counter that went down was reset, so
    its new value is the growth. The first sample of a series has no growth to tell.
    """
    rows = samples.withColumn("series", series_key(F.col("labels")))
    before = previous(
        rows, ["metric", "series"], "ts", "value",
        F.floor(epoch_seconds(F.col("ts")) / DAY), name="before",
    )
    grown = F.col("value") - F.col("before")
    return before.withColumn("delta", F.when(grown < 0, F.col("value")).otherwise(grown)).drop("before")


def counter_rate(samples: DataFrame, window: int, by: Sequence[str] = ()) -> DataFrame:
    """
    ``increase`` and per-second ``rate`` of each metric in epoch-aligned windows, summed
    over all series that share the ``by`` labels.
    """
    deltas = counter_deltas(samples).filter(F.col("delta").isNotNull())
    keys = [F.col("labels")[label].alias(label) for label in by]
    return (
        deltas.groupBy("metric", *keys, window_start(F.col("ts"), window).alias("t"))
        .agg(F.sum("delta").alias("increase"))
        .withColumn("rate", F.col("increase") / F.lit(window))
    )


def rolling_rate(rates: DataFrame, keys: Sequence[str], window: int) -> DataFrame:
    """
    Per-second rate over the trailing ``window`` at each step, from stepwise increases.
    A key's steps are ordered in chunks of time; a chunk also gets the last ``window`` of the
    one before, so no key is in one task however long it goes on.
    """
    size = max(DAY, window)
    chunk = F.floor(F.col("t") / size)
    # The next chunk looks back at the steps from its start less the window on.
    reaches = F.col("t") > (chunk + 1) * size - window
    dealt = rates.withColumn("_own", chunk).withColumn(
        "_chunk", F.explode(F.when(reaches, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))))
    trailing = Window.partitionBy(*keys, "_chunk").orderBy("t").rangeBetween(-window + 1, 0)
    return dealt.withColumn("rate", F.sum("increase").over(trailing) / F.lit(window)).filter(
        F.col("_chunk") == F.col("_own")).drop("_own", "_chunk")


# -- gauges -------------------------------------------------------------------

def gauge_by_label(samples: DataFrame, fn: str, label: str | None, window: int) -> DataFrame:
    """
    Latest value of every series per window, then ``sum`` or ``max`` over the series
    that share ``label`` (all of them without a label).
    """
    if fn not in ("sum", "max"):
        raise ValueError(f"unsupported gauge aggregate {fn!r}")
    key = F.col("labels")[label] if label else F.lit("")
    last = (
        samples.withColumn("series", series_key(F.col("labels")))
        .groupBy("metric", "series", key.alias("label"), window_start(F.col("ts"), window).alias("t"))
        .agg(F.max_by("value", "ts").alias("value"))
    )
    total = F.sum("value") if fn == "sum" else F.max("value")
    return last.groupBy("metric", "label", "t").agg(total.alias("value"))


# -- histograms ---------------------------------------------------------------

def observe(values: DataFrame, value: str, bounds: Sequence[float], keys: Sequence = ()) -> DataFrame:
    """
    Cumulative histogram: per key and bound, how many values are at most the bound. The
    last bound is +Inf. Each row feeds one conditional count per bound, in one pass.
    """
    edges = [*[float(b) for b in bounds], float("inf")]
    counts = [F.count_if(F.col(value) <= F.lit(edge)).alias(f"_le{i}") for i, edge in enumerate(edges)]
    wide = values.groupBy(*keys).agg(*counts)
    buckets = F.explode(F.array(*[
        F.struct(F.lit(edge).alias("le"), F.col(f"_le{i}").alias("cumulative"))
        for i, edge in enumerate(edges)
    ]))
    names = [c for c in wide.columns if not c.startswith("_le")]
    return wide.select(*names, buckets.alias("_b")).select(*names, "_b.le", "_b.cumulative")


def bucket_quantile(buckets: Column, q: Column | float) -> Column:
    """
    Quantile of a cumulative histogram, an array of (le, cumulative) in order, linear inside the bucket
    that holds the rank. A rank beyond the last finite bound gives that bound; an empty
    histogram gives null.
    """
    rank = q * F.element_at(buckets, -1)["cumulative"]
    start = F.struct(F.lit(0.0).alias("low"), F.lit(0.0).alias("below"), F.lit(None).cast("double").alias("found"))

    def step(so_far: Column, bucket: Column) -> Column:
        held, le = bucket["cumulative"].cast("double"), bucket["le"]
        inside = so_far["low"] + (le - so_far["low"]) * (rank - so_far["below"]) / (held - so_far["below"])
        here = F.when((le == float("inf")) | (held == so_far["below"]), so_far["low"]).otherwise(inside)
        return F.struct(le.alias("low"), held.alias("below"), F.coalesce(
            so_far["found"], F.when((held >= rank) & (held > 0), here)).alias("found"))

    return F.aggregate(buckets, start, step, lambda end: end["found"])


def histogram_quantile(buckets: DataFrame, q: float, keys: Sequence[str] = (), name: str = "quantile") -> DataFrame:
    """``bucket_quantile`` per key of rows (le, cumulative); a key has one row per bound."""
    held = F.sort_array(F.collect_list(F.struct("le", "cumulative")))
    return buckets.groupBy(*keys).agg(held.alias("_buckets")).select(*keys, bucket_quantile(F.col("_buckets"), float(q)).alias(name))
