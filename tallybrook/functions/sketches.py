"""Mergeable distinct counts of editors, and mergeable counts of the most active ones."""

from math import ceil, log2

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybrook.settings import SKETCH_LG


def editors_state(user: Column) -> Column:
    """
    Aggregate users into a sketch. Nulls are ignored, an empty name is an editor:
    the sketch itself skips empty strings, hence the marker in front.
    """
    return F.theta_sketch_agg(F.concat(F.lit("="), user), SKETCH_LG)


def editors_merge(state: Column) -> Column:
    """Aggregate sketches into their union."""
    return F.theta_union_agg(state, SKETCH_LG)


def editors_estimate(state: Column) -> Column:
    """Distinct editors held in one sketch."""
    return F.theta_sketch_estimate(state).cast("long")


def heavy_state(item: str, tracked: int) -> Column:
    """Aggregate the column ``item`` into a counter sketch that tracks about ``tracked`` items. Nulls are ignored."""
    return F.expr(f"approx_top_k_accumulate(`{item}`, {int(tracked)})")


def heavy_merge(state: str, tracked: int) -> Column:
    """Aggregate counter sketches into that of all their items."""
    return F.expr(f"approx_top_k_combine(`{state}`, {int(tracked)})")


def heavy_items(state: str, tracked: int) -> Column:
    """What a counter sketch tracks, as (item, count), most frequent first, ties by item."""
    found = F.expr(f"approx_top_k_estimate(`{state}`, {int(tracked)})")
    ordered = F.array_sort(F.transform(found, lambda x: F.struct((-x["count"]).alias("less"), x["item"].alias("item"))))
    return F.transform(ordered, lambda x: F.struct(x["item"].alias("item"), (-x["less"]).alias("count")))


def heavy_error(items: Column, total: Column, tracked: int) -> Column:
    """
    How far a count of the sketch can be off, with ``total`` items put in: not at all where the tracked counts
    add up to the total, as then nothing was dropped; else by the sketch's own bound.
    """
    slots = 1 << max(3, ceil(log2(tracked / 0.75)))
    held = F.aggregate(items, F.lit(0).cast("long"), lambda n, x: n + x["count"])
    return F.when(held == total, F.lit(0)).otherwise(F.ceil(total * 3.5 / slots)).cast("long")
