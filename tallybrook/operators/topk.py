"""Ordered cuts, globally and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows; each task keeps only its own best ``limit`` rows."""
    return df.orderBy(*order).limit(limit)


def top_k_per_group(
    counts: DataFrame, groups: Sequence[str], measure: str, name: str, k: int, rank: str | None = None
) -> DataFrame:
    """
    The ``k`` largest rows of each group by ``measure``, ties by ``name``.

    The rank filter is applied by each task before the shuffle as well, so a group
    holding a third of the rows arrives as at most ``k`` rows per task.
    """
    by_size = Window.partitionBy(*groups).orderBy(F.col(measure).desc(), F.col(name).asc())
    ranked = counts.withColumn("_rank", F.row_number().over(by_size)).filter(F.col("_rank") <= k)
    return ranked.withColumnRenamed("_rank", rank) if rank else ranked.drop("_rank")


def bounded_semi(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keep the rows whose key is among ``keys``, a result already cut by a limit."""
    return df.join(F.broadcast(keys), list(on), "left_semi")
