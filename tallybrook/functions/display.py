"""Derived figures: rates, shares, status bands and the console line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def per_second(total: Column, size: Column | int) -> Column:
    """Rate of a window, rounded half-even to two places; 0 for an empty size."""
    size = size if isinstance(size, Column) else F.lit(size)
    return F.when(size != 0, F.bround(total / size, 2)).otherwise(F.lit(0.0))


def bot_rate(rate: Column, bots: Column, total: Column) -> Column:
    """The bots' part of a window's rate; independent of the window size."""
    return F.when(total > 0, rate * (bots / total)).otherwise(F.lit(0.0))


def per_minute(count: Column, bucket_seconds: int) -> Column:
    return count / F.lit(bucket_seconds / 60)


def shown(value: Column, places: int) -> Column:
    """
    A figure of 0 or more rounded to 1 or 2 places as it is displayed: the number of tenths or hundredths that is
    nearest to the double's exact value, and of two equally near ones the larger. ``round`` looks at the
    shortest decimal of a double instead, which can lie on the other side of a tie.
    """
    # Twice the scaled value, exactly: a sum of products with powers of two, with the errors of its additions.
    parts = {1: (16.0, 4.0), 2: (128.0, 64.0, 8.0)}[places]
    value = value.cast("double")
    total, error = value * parts[0], F.lit(0.0)
    for factor in parts[1:]:
        other = value * factor
        added = total + other
        kept = added - total
        error = error + ((total - (added - kept)) + (other - kept))
        total = added
    # Just below the middle between two, though the sum was rounded up to it.
    below = (total == F.floor(total)) & (F.pmod(total, F.lit(2.0)) == 1) & (error < 0)
    nearest = F.floor((total + 1) / 2) - F.when(below, 1).otherwise(0)
    return nearest / F.lit(10.0**places)


def share_percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * F.lit(100.0) / whole)


def status_band(value: Column, steps: Sequence[tuple[float | None, str]]) -> Column:
    """
    The band a value falls into. ``steps`` are (lower edge, band) in rising order;
    the first edge is None and covers everything below the second. Null stays null.
    """
    band = F.lit(steps[0][1])
    for edge, name in steps[1:]:
        band = F.when(value >= F.lit(edge), F.lit(name)).otherwise(band)
    return F.when(value.isNotNull(), band)


def console_line(
    start: Column, total: Column, rate: Column, wikis: Column, bots: Column, humans: Column
) -> Column:
    """One log line per window: clock, edits, rate, the four busiest wikis, bot share."""
    seen = bots + humans
    share = F.when(seen > 0, bots * F.lit(100.0) / seen).otherwise(F.lit(0.0))
    busiest = F.array_join(
        F.transform(
            F.slice(wikis, 1, 4),
            lambda w: F.format_string("%s: %,d", w["key"], w["count"]),
        ),
        ", ",
    )
    return F.format_string(
        "[%s] %,5d edits (%6.1f/s) | %s | bots: %.0f%%",
        F.date_format(F.timestamp_seconds(start), "HH:mm:ss"),
        total,
        rate,
        F.when(busiest == "", F.lit("-")).otherwise(busiest),
        F.bround(share, 0),
    )
