"""Range queries over the stored rollups and raw edits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.clock import (
    AsOf, as_of_column, bucket_start, epoch_of, epoch_seconds, seconds_interval,
)
from tallybrook.functions import display
from tallybrook.functions.display import per_minute, share_percent
from tallybrook.functions.sketches import editors_estimate
from tallybrook.operators.rollup import merge_rollups
from tallybrook.operators.topk import top_k_per_group, top_n
from tallybrook.settings import (
    BUCKETS, DEFAULT_BUCKET, EDITOR_MAX_RANGE, MAX_LIMIT, MAX_POINTS, RANGES, RETENTION_DAYS,
)

DAY = 86_400


class Refused(ValueError):
    """What was asked for is not on offer; the text says what is."""


def _offered(kind: str, choices: dict[str, int], name: str) -> int:
    if name not in choices:
        raise Refused(f"no {kind} named {name!r}: choose from {sorted(choices, key=choices.get)}")
    return choices[name]


def range_seconds(name: str) -> int:
    return _offered("range", RANGES, name)


def bucket_seconds(name: str) -> int:
    return _offered("bucket", BUCKETS, name)


def checked_limit(limit: int) -> int:
    if limit not in range(1, MAX_LIMIT + 1):
        raise Refused(f"a list has 1 to {MAX_LIMIT} rows, not {limit}")
    return limit


def checked_retention(name: str, table: str) -> int:
    """The seconds of a range that ``table`` still holds whole."""
    asked, kept = range_seconds(name), RETENTION_DAYS[table]
    if kept is not None and asked > kept * DAY:
        raise Refused(f"{name} goes back further than the {kept} days in {table}")
    return asked


@dataclass(frozen=True)
class ChartSpec:
    """What a chart spans and how it is divided. One that cannot be drawn cannot be made."""

    range: str
    bucket: str

    def __post_init__(self) -> None:
        points = self.seconds // self.step
        if not 1 <= points <= MAX_POINTS:
            raise Refused(f"{self.bucket} buckets over {self.range} give {points} points; 1 to {MAX_POINTS} can be drawn")
        checked_retention(self.range, "edits_1d" if self.daily else "edits_1m")

    @property
    def seconds(self) -> int:
        return range_seconds(self.range)

    @property
    def step(self) -> int:
        return bucket_seconds(self.bucket)

    @property
    def daily(self) -> bool:
        return self.step % DAY == 0


# The date folders of the stored tables, by the column they are cut from.
DATE_FOLDERS = {"ingested_at": "ingest_date", "minute": "minute_date", "day": "day_date"}


def _pruned(df: DataFrame, column: str, start: Column) -> DataFrame:
    """On a stored table, also bound the date folder, so that older folders go unread."""
    folder = DATE_FOLDERS.get(column)
    return df.filter(F.col(folder) >= F.to_date(start)) if folder in df.columns else df


def since(df: DataFrame, column: str, seconds: int, as_of: AsOf = None) -> DataFrame:
    """Rows of the last ``seconds``: lower bound included, no upper bound."""
    start = as_of_column(df, column, as_of) - seconds_interval(seconds)
    return _pruned(df, column, start).filter(F.col(column) >= start)


def since_day(df: DataFrame, column: str, seconds: int, as_of: AsOf = None) -> DataFrame:
    """Rows of the days from the one ``seconds`` ago on, that day included whole."""
    moment = F.current_timestamp() if as_of is None else (
        as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp_ntz")
    )
    start = moment - seconds_interval(seconds)
    return _pruned(df, column, start).filter(F.col(column) >= F.to_date(start))


def recent_days(df: DataFrame, column: str, as_of: AsOf = None, days: int = 2) -> DataFrame:
    """Rows of the last ``days`` calendar days: a bound on the date alone, so whole date folders go unread."""
    start = F.date_sub(as_of_column(df, column, as_of).cast("date"), days - 1)
    return _pruned(df, column, start).filter(F.col(column) >= start.cast(df.schema[column].dataType))


def timeline(
    minute: DataFrame, daily: DataFrame, range_: str, bucket: str, as_of: AsOf = None
) -> DataFrame:
    """
    The sums of each bucket with stored rows; other buckets have no row. Reads the coarsest
    rollup that the buckets are whole multiples of.
    """
    ask = ChartSpec(range_, bucket)
    if ask.daily:
        rows = since_day(daily, "day", ask.seconds, as_of)
        t = F.unix_seconds(F.col("day").cast("timestamp"))
    else:
        rows = since(minute, "minute", ask.seconds, as_of)
        t = epoch_seconds(bucket_start(F.col("minute"), ask.step))
    merged = merge_rollups(rows, t.alias("t"))
    return merged.withColumn("editors", editors_estimate(F.col("editors"))).orderBy("t")


def top_wikis(minute: DataFrame, range_: str, limit: int, as_of: AsOf = None) -> DataFrame:
    """The busiest wikis of a range, from the minute rollup."""
    seconds, limit = checked_retention(range_, "edits_1m"), checked_limit(limit)
    merged = merge_rollups(since(minute, "minute", seconds, as_of), "wiki")
    best = top_n(merged, [F.col("edits").desc(), F.col("wiki").asc()], limit)
    return best.select("wiki", "edits", "bot_edits", editors_estimate(F.col("editors")).alias("editors"))


def top_editors(edits: DataFrame, range_: str, limit: int, as_of: AsOf = None) -> DataFrame:
    """
    The most active editors, from raw edits, each message counted once however often it
    was delivered.

    Messages are made unique first and then added up by (user, wiki) and by user; every
    step is a hash aggregate with a map-side half, so one user or wiki holding a third
    of the rows is spread over all tasks until it is a single row per task.
    """
    seconds, limit = checked_retention(range_, "edits"), checked_limit(limit)
    rows = since(edits, "ingested_at", seconds, as_of).filter(F.col("user").isNotNull())
    messages = rows.groupBy("user", "wiki", "kafka_partition", "kafka_offset").agg(
        F.max(F.col("bot").cast("int")).alias("bot")
    )
    by_wiki = messages.groupBy("user", "wiki").agg(
        F.count("*").alias("edits"), F.sum("bot").alias("bot_edits")
    )
    by_user = by_wiki.groupBy("user").agg(
        F.sum("edits").alias("edits"),
        F.sum("bot_edits").alias("bot_edits"),
        F.count("*").alias("wikis"),
    )
    return top_n(by_user, [F.col("edits").desc(), F.col("user").asc()], limit)


def freshness(edits: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Seconds since the newest edit of the last two days, in milliseconds' precision; null if none."""
    now = as_of_column(edits, "ingested_at", as_of)
    newest = recent_days(edits, "ingested_at", as_of).agg(F.max("ingested_at").alias("newest"))
    age = F.unix_millis(now.cast("timestamp")) - F.unix_millis(F.col("newest").cast("timestamp"))
    return newest.select((age / F.lit(1000.0)).alias("age_seconds"))


# -- history view -------------------------------------------------------------

def timeline_grid(points: DataFrame, range_: str, bucket: str, as_of) -> DataFrame:
    """
    The points on every bucket of the range, first and last included, null where there
    is none. Points outside the chart are cut off first, so at most ``MAX_POINTS`` + 1 are
    broadcast.
    """
    ask, now = ChartSpec(range_, bucket), epoch_of(as_of)
    end = now // ask.step * ask.step
    start = (now - ask.seconds) // ask.step * ask.step
    grid = points.sparkSession.range(start, end + ask.step, ask.step).toDF("t")
    shown = points.filter(F.col("t").between(start, end))
    return grid.join(F.broadcast(shown), "t", "left").orderBy("t")


def timeline_rates(points: DataFrame, bucket: str, shown: bool = False) -> DataFrame:
    """
    Edits and bot edits per minute of each bucket; a missing bucket stays null. Unrounded, or with
    ``shown`` to the one place that a chart displays.
    """
    step = bucket_seconds(bucket)
    rates = {"edits_per_minute": per_minute(F.col("edits"), step), "bot_edits_per_minute": per_minute(F.col("bot_edits"), step)}
    return points.select("t", *[(display.shown(rate, 1) if shown else rate).alias(name) for name, rate in rates.items()])


def range_tiles(points: DataFrame, wikis: DataFrame) -> DataFrame:
    """
    Headline numbers of a range: total, bot share, new pages and the busiest wiki.
    Distinct editors are left out: they cannot be added up over buckets.
    """
    totals = points.agg(
        F.coalesce(F.sum("edits"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("bot_edits"), F.lit(0)).alias("bots"),
        F.coalesce(F.sum("new_pages"), F.lit(0)).alias("new_pages"),
    )
    first = top_n(wikis, [F.col("edits").desc(), F.col("wiki").asc()], 1)
    busiest = first.select(F.struct("wiki", "edits").alias("w"))
    row = totals.unionByName(busiest, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("total", "bots", "new_pages", "w")])
    return row.select(
        "total",
        share_percent(F.col("bots"), F.col("total")).alias("bot_percent"),
        "new_pages",
        F.col("w.wiki").alias("busiest_wiki"),
        F.col("w.edits").alias("busiest_wiki_edits"),
    )


def history_report(minute: DataFrame, daily: DataFrame, edits: DataFrame, range_: str, as_of=None, limit: int = 10) -> dict[str, DataFrame]:
    """
    All parts of the history view for one range: the timeline on its fixed bucket, the
    tiles, and both top lists. Editors come from the raw table; where it keeps less than the
    range, their list covers ``EDITOR_MAX_RANGE``, and its column ``range`` says so.
    """
    range_seconds(range_)
    bucket = DEFAULT_BUCKET[range_]
    points = timeline(minute, daily, range_, bucket, as_of)
    wikis = top_wikis(minute, range_, limit, as_of)
    return {
        "timeline": timeline_rates(timeline_grid(points, range_, bucket, as_of), bucket),
        "tiles": range_tiles(points, wikis),
        "top_wikis": wikis,
        "top_editors": top_editors(edits, editor_range(range_), limit, as_of).withColumn(
            "range", F.lit(editor_range(range_))),
    }


def history_tiles(minute: DataFrame, as_of: str) -> DataFrame:
    """
    The tiles of every range at once, in one pass over the minute rollup: each rollup
    row is counted into the ranges it belongs to, by the rule of the range's own bucket.
    """
    now = F.lit(as_of).cast(minute.schema["minute"].dataType)

    def member(name: str) -> Column:
        start = now - seconds_interval(RANGES[name])
        exact = F.col("minute") >= start
        if ChartSpec(name, DEFAULT_BUCKET[name]).daily:
            charted = F.to_date("minute") >= F.to_date(start)
        else:
            charted = exact
        return F.struct(
            F.lit(name).alias("range"), charted.alias("charted"), exact.alias("exact")
        )

    widest = max(RANGES, key=RANGES.__getitem__)
    rows = minute.filter(F.to_date("minute") >= F.to_date(now - seconds_interval(RANGES[widest])))
    per_wiki = (
        rows.groupBy("minute", "wiki")
        .agg(*[F.sum(c).alias(c) for c in ("edits", "bot_edits", "new_pages")])
        .withColumn("m", F.explode(F.array(*[member(name) for name in RANGES])))
        .groupBy(F.col("m.range").alias("range"), "wiki")
        .agg(
            *[F.coalesce(F.sum(F.when(F.col("m.charted"), F.col(c))), F.lit(0)).alias(c)
              for c in ("edits", "bot_edits", "new_pages")],
            F.sum(F.when(F.col("m.exact"), F.col("edits"))).alias("ranked_edits"),
        )
    )
    totals = per_wiki.groupBy("range").agg(
        *[F.sum(c).alias(c) for c in ("edits", "bot_edits", "new_pages")]
    )
    busiest = top_k_per_group(
        per_wiki.filter(F.col("ranked_edits").isNotNull()), ["range"], "ranked_edits", "wiki", 1
    ).select("range", F.col("wiki").alias("busiest_wiki"), F.col("ranked_edits").alias("busiest_wiki_edits"))
    return totals.join(busiest, "range", "left").select(
        "range",
        F.col("edits").alias("total"),
        share_percent(F.col("bot_edits"), F.col("edits")).alias("bot_percent"),
        "new_pages",
        "busiest_wiki",
        "busiest_wiki_edits",
    )


def editor_range(range_: str) -> str:
    return EDITOR_MAX_RANGE if range_seconds(range_) > RANGES[EDITOR_MAX_RANGE] else range_
