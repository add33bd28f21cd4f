"""
Order-dependent columns over long series.

A plain window over a series puts the whole series in one task. Here a series is
cut into chunks of its order: each chunk is reduced to one row, the few chunk rows
are scanned in order, and what they carry is joined back, so rows are only ever
ordered inside a chunk. Callers pick chunks that are bounded in size, such as a range
of offsets or a day of samples. The join and the inner ordering need the same
partitioning, by (series, chunk), so the rows are shuffled once; the reduction reads its
three columns in a scan of its own and shuffles one row per task and chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNK = "_chunk"


def _carried(
    df: DataFrame, keys: Sequence[str], chunk: Column, summary: Column, carry
) -> DataFrame:
    rows = df.withColumn(_CHUNK, chunk)
    heads = rows.groupBy(*keys, _CHUNK).agg(summary.alias("_summary"))
    over = Window.partitionBy(*keys).orderBy(_CHUNK)
    heads = heads.withColumn("_carry", carry(over)).drop("_summary")
    return rows.join(heads, [*keys, _CHUNK], "left")


def running_max(
    df: DataFrame, keys: Sequence[str], order: str, value: str, chunk: Column, *, name: str,
    include_current: bool = True,
) -> DataFrame:
    """Add ``name``: the largest ``value`` up to (or strictly before) each row of its series."""
    rows = _carried(
        df, keys, chunk, F.max(value),
        lambda over: F.max("_summary").over(over.rowsBetween(Window.unboundedPreceding, -1)),
    )
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0 if include_current else -1
    )
    best = F.greatest(F.max(value).over(inside), F.col("_carry"))
    return rows.withColumn(name, best).drop("_carry", _CHUNK)


def previous(
    df: DataFrame, keys: Sequence[str], order: str, value: str, chunk: Column, *, name: str
) -> DataFrame:
    """Add ``name``: the ``value`` of the row before, over the whole series."""
    rows = _carried(
        df, keys, chunk, F.max_by(value, order), lambda over: F.lag("_summary").over(over)
    )
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(order)
    first = F.row_number().over(inside) == 1
    before = F.when(first, F.col("_carry")).otherwise(F.lag(value).over(inside))
    return rows.withColumn(name, before).drop("_carry", _CHUNK)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], chunk: Column
) -> DataFrame:
    """Replace each of ``values`` by its sum up to each row of its series."""
    rows = _carried(
        df, keys, chunk, F.struct(*[F.sum(v).alias(v) for v in values]),
        lambda over: F.struct(*[
            F.coalesce(F.sum(f"_summary.{v}").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(v)
            for v in values]),
    )
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({v: F.sum(v).over(inside) + F.col(f"_carry.{v}") for v in values}).drop("_carry", _CHUNK)


def offset_chunk(offset: str = "kafka_offset", size: int = 100_000) -> Column:
    return F.floor(F.col(offset) / size)
