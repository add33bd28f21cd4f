"""Counts packed in arrays, ordered by count and then by name."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ranked(key: Column, count: Column, when: Column | None = None, name: str = "key") -> Column:
    """
    Aggregate ``(key, count)`` rows into one array, largest count first, ties by name.

    Only for keys whose number per group is bounded (wikis, types, an already cut
    top-k): the array is one group's whole content.
    """
    item = F.struct((-count).alias("order"), key.alias("key"))
    if when is not None:
        item = F.when(when, item)
    ordered = F.array_sort(F.collect_list(item))
    return F.transform(ordered, lambda x: F.struct(x["key"].alias(name), (-x["order"]).alias("count")))


def counts_text(counts: Column, name: str = "key") -> Column:
    """``a=3,b=1`` rendering of a packed array, for flat outputs."""
    return F.array_join(
        F.transform(counts, lambda x: F.concat(x[name], F.lit("="), x["count"].cast("string"))), ","
    )
