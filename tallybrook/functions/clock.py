"""Epoch-aligned time arithmetic that works on TIMESTAMP and TIMESTAMP_NTZ alike."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = str | datetime | Column | None


def as_of_column(df: DataFrame, column: str, as_of: AsOf) -> Column:
    """``as_of`` as a value of the same type as ``df[column]``; None means now."""
    kind = df.schema[column].dataType
    if as_of is None:
        return F.current_timestamp().cast(kind)
    if isinstance(as_of, Column):
        return as_of.cast(kind)
    return F.lit(text_of(as_of)).cast(kind)


def text_of(as_of: str | datetime) -> str:
    return as_of if isinstance(as_of, str) else as_of.isoformat(sep=" ")


def seconds_interval(seconds: float) -> Column:
    return F.make_dt_interval(secs=F.lit(seconds))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def bucket_start(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned ``[start, start + seconds)`` bucket, as a timestamp."""
    return F.window(ts, f"{seconds} seconds").start


def window_start(ts: Column, size: int) -> Column:
    """The same start in whole epoch seconds, the key of all live windows."""
    at = epoch_seconds(ts)
    return at - F.pmod(at, F.lit(size))


def align_micros(micros: Column, size: int) -> Column:
    """Snap an epoch-microsecond clock down to its window start in seconds."""
    step = F.lit(size * 1_000_000)
    return ((micros - F.pmod(micros, step)) / F.lit(1_000_000)).cast("long")


def epoch_of(as_of: str | datetime | None) -> int:
    """Whole epoch seconds of a driver-side moment, read as UTC."""
    from datetime import timezone

    if as_of is None:
        return int(datetime.now(timezone.utc).timestamp())
    moment = datetime.fromisoformat(text_of(as_of))
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return int(moment.timestamp())


def day_of(as_of: str | datetime | None) -> date:
    from datetime import timezone

    return datetime.fromtimestamp(epoch_of(as_of), timezone.utc).date()
