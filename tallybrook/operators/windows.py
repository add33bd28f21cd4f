"""Tumbling windows: slices per topic partition, their merge and what readers see."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.functions.clock import epoch_micros, window_start
from tallybrook.functions.display import bot_rate, per_second, share_percent
from tallybrook.functions.packing import ranked
from tallybrook.functions.sketches import heavy_error, heavy_items, heavy_merge, heavy_state
from tallybrook.operators.topk import bounded_semi, top_k_per_group
from tallybrook.settings import (
    ANONYMOUS, EDITORS_TRACKED, HISTORY_WINDOWS, TOP_EDITORS, TOP_WIKIS_SHOWN, UNKNOWN, WINDOW_TTL_SECONDS,
)


def normalize(events: DataFrame) -> DataFrame:
    """Live-path placeholders: null and empty names count under a stand-in, null bot is human."""

    def filled(name: str, stand_in: str) -> Column:
        return F.when(F.col(name) != "", F.col(name)).otherwise(F.lit(stand_in))

    return events.withColumns({
        "wiki": filled("wiki", UNKNOWN),
        "type": filled("type", UNKNOWN),
        "user": filled("user", ANONYMOUS),
        "bot": F.coalesce(F.col("bot"), F.lit(False)),
    })


def event_clock(events: DataFrame, source: str, payload: str = "event_time", arrival: str = "ingested_at") -> Column:
    """
    The clock that places an event: ``arrival``, or the payload's own clock where it is
    present and positive, with arrival as the fallback.
    """
    if source == "arrival":
        return F.col(arrival)
    if source != "event":
        raise ValueError(f"unknown time source {source!r}")
    return F.when(epoch_micros(F.col(payload)) > 0, F.col(payload)).otherwise(F.col(arrival))


def assign_window(events: DataFrame, ts: Column, size: int) -> DataFrame:
    """Add the ``[window_start, window_end)`` an event falls into, in epoch seconds."""
    start = window_start(ts, size)
    return events.withColumn("window_start", start).withColumn(
        "window_end", F.col("window_start") + F.lit(size)
    )


# -- slices -------------------------------------------------------------------

def dimension_counts(events: DataFrame, keys: Sequence) -> DataFrame:
    """
    Counts of normalized events by (keys, dimension, value), dimension being wiki or type.

    Rows are fanned out before a partial aggregate that has a handful of values per
    key, so almost nothing of the fan-out is shuffled.
    """
    pairs = F.explode(F.array(
        F.struct(F.lit("wiki").alias("dim"), F.col("wiki").alias("value")),
        F.struct(F.lit("type").alias("dim"), F.col("type").alias("value")),
    ))
    return (
        events.select(*keys, "bot", pairs.alias("_pair"))
        .groupBy(*keys, F.col("_pair.dim").alias("dim"), F.col("_pair.value").alias("value"))
        .agg(F.count("*").alias("n"), F.count_if(F.col("bot")).alias("bots"))
    )


def user_counts(events: DataFrame, keys: Sequence) -> DataFrame:
    return events.groupBy(*keys, "user").agg(F.count("*").alias("count"))


def pack_slices(
    dims: DataFrame, users: DataFrame, size: int, k: int = TOP_EDITORS,
    keys: Sequence[str] = ("window_start", "partition"),
) -> DataFrame:
    """
    Long-form counts by ``keys`` as one row per key, by default a slice per topic partition.

    Users are cut to the top ``k`` before they are packed; wikis and types are packed
    whole, as a slice lists all of them.
    """
    keys = list(keys)
    is_type, is_wiki = F.col("dim") == "type", F.col("dim") == "wiki"
    body = dims.groupBy(*keys).agg(
        F.sum(F.when(is_type, F.col("n"))).alias("total_edits"),
        F.sum(F.when(is_type, F.col("bots"))).alias("_bots"),
        ranked(F.col("value"), F.col("n"), is_wiki).alias("edits_per_wiki"),
        ranked(F.col("value"), F.col("n"), is_type).alias("edit_types"),
    )
    top = (
        top_k_per_group(users, keys, "count", "user", k)
        .groupBy(*keys)
        .agg(ranked(F.col("user"), F.col("count"), name="user").alias("top_editors"))
    )
    return body.join(top, keys, "left").select(
        "window_start",
        (F.col("window_start") + F.lit(size)).alias("window_end"),
        *keys[1:],
        "total_edits",
        per_second(F.col("total_edits"), size).alias("edits_per_second"),
        "edits_per_wiki",
        F.struct(
            F.col("_bots").alias("bot"), (F.col("total_edits") - F.col("_bots")).alias("human")
        ).alias("bot_vs_human"),
        "edit_types",
        "top_editors",
    )


def window_slices(events: DataFrame, ts: Column, size: int, k: int = TOP_EDITORS) -> DataFrame:
    """
    Summary of every non-empty window, one slice per topic partition.

    The two counts read different columns of the input, so scanning it twice costs
    little more than once and keeps both on a single map-side combined shuffle.
    """
    keyed = normalize(events).select(
        window_start(ts, size).alias("window_start"),
        F.col("kafka_partition").alias("partition"),
        "wiki", "type", "user", "bot",
    )
    keys = ["window_start", "partition"]
    return pack_slices(dimension_counts(keyed, keys), user_counts(keyed, keys), size, k)


def window_summaries(events: DataFrame, ts: Column, size: int, k: int = TOP_EDITORS) -> DataFrame:
    """
    Summary of every non-empty window over all its partitions, straight from the events.

    Counts are aggregated by window at once instead of by slice first, and top editors are
    chosen from all users, so they are exact; ``merge_slices`` is for slices that are written.
    """
    keyed = normalize(events).select(
        window_start(ts, size).alias("window_start"),
        F.col("kafka_partition").alias("partition"),
        "wiki", "type", "user", "bot",
    )
    keys = ["window_start"]
    partitions = keyed.select("window_start", "partition").distinct().groupBy("window_start").agg(
        F.count("*").cast("int").alias("partitions"))
    whole = pack_slices(dimension_counts(keyed, keys), user_counts(keyed, keys), size, k, keys)
    return whole.join(partitions, "window_start")


def newest_events(events: DataFrame, ts: str, size: int, n: int = 1) -> DataFrame:
    """
    The events of the newest ``n`` windows of the grid, by a bound on the column ``ts`` that
    reaches the scan. Only the newest clock is read to find it.
    """
    newest = events.agg(F.max(window_start(F.col(ts), size))).first()[0]
    if newest is None:
        return events.limit(0)
    bound = F.timestamp_seconds(F.lit(newest - (n - 1) * size)).cast(events.schema[ts].dataType)
    return events.filter(F.col(ts) >= bound)


# -- merging ------------------------------------------------------------------

def merge_slices(slices: DataFrame, k: int = TOP_EDITORS) -> DataFrame:
    """
    Slices of a window, whoever wrote them, as the one summary readers see.

    Counts add up exactly; the rate is recomputed from the merged total; top editors
    come from the slices' own cuts and can miss a user who is below all of them.
    """

    def tagged(dim: str, items: str, key: str) -> Column:
        return F.transform(
            F.col(items),
            lambda x: F.struct(F.lit(dim).alias("dim"), x[key].alias("key"), x["count"].alias("n")),
        )

    def single(dim: str, n: Column) -> Column:
        return F.struct(F.lit(dim).alias("dim"), F.lit("").alias("key"), n.cast("long").alias("n"))

    parts = F.concat(
        tagged("wiki", "edits_per_wiki", "key"),
        tagged("type", "edit_types", "key"),
        F.coalesce(tagged("user", "top_editors", "user"), F.array().cast("array<struct<dim:string,key:string,n:bigint>>")),
        F.array(
            single("total", F.col("total_edits")),
            single("bot", F.col("bot_vs_human.bot")),
            single("human", F.col("bot_vs_human.human")),
            single("slice", F.lit(1)),
        ),
    )
    keys = ["window_start", "window_end"]
    sums = (
        slices.select(*keys, F.explode(parts).alias("p"))
        .groupBy(*keys, "p.dim", "p.key")
        .agg(F.sum("p.n").alias("n"))
    )

    def of(dim: str) -> Column:
        return F.sum(F.when(F.col("dim") == dim, F.col("n")))

    merged = sums.groupBy(*keys).agg(
        of("total").alias("total_edits"),
        of("bot").alias("_bot"),
        of("human").alias("_human"),
        of("slice").alias("partitions"),
        ranked(F.col("key"), F.col("n"), F.col("dim") == "wiki").alias("edits_per_wiki"),
        ranked(F.col("key"), F.col("n"), F.col("dim") == "type").alias("edit_types"),
        F.slice(ranked(F.col("key"), F.col("n"), F.col("dim") == "user", "user"), 1, k).alias("top_editors"),
    )
    return merged.select(
        *keys,
        "total_edits",
        per_second(F.col("total_edits"), F.col("window_end") - F.col("window_start")).alias("edits_per_second"),
        "edits_per_wiki",
        F.struct(F.col("_bot").alias("bot"), F.col("_human").alias("human")).alias("bot_vs_human"),
        "edit_types",
        "top_editors",
        F.col("partitions").cast("int").alias("partitions"),
    )


def window_points(slices: DataFrame) -> DataFrame:
    """The four numbers a chart needs, from four slice columns and nothing else."""
    return (
        slices.groupBy("window_start", "window_end")
        .agg(F.sum("total_edits").alias("total"), F.sum("bot_vs_human.bot").alias("bot"))
        .select(
            F.col("window_start").alias("t"),
            "total",
            per_second(F.col("total"), F.col("window_end") - F.col("window_start")).alias("rate"),
            "bot",
        )
    )


# -- readers ------------------------------------------------------------------

def newest_windows(slices: DataFrame, n: int) -> DataFrame:
    return slices.select("window_start").distinct().orderBy(F.col("window_start").desc()).limit(n)


def trim(slices: DataFrame, n: int = HISTORY_WINDOWS) -> DataFrame:
    """Every slice of the newest ``n`` windows; older windows go, index and payload together."""
    return bounded_semi(slices, newest_windows(slices, n), ["window_start"])


def window_history(slices: DataFrame, limit: int = HISTORY_WINDOWS, cap: int = HISTORY_WINDOWS) -> DataFrame:
    """Points of the newest windows, oldest first."""
    if not 1 <= limit <= cap:
        raise ValueError(f"cannot give {limit} windows: from 1 to {cap} are kept")
    return window_points(trim(slices, limit)).orderBy("t")


def window_latest(slices: DataFrame, k: int = TOP_EDITORS) -> DataFrame:
    """The newest window, merged. ``partitions`` says how many slices it has so far."""
    return merge_slices(trim(slices, 1), k)


def within_ttl(slices: DataFrame, written_at: Column, as_of_epoch: int, ttl: int = WINDOW_TTL_SECONDS) -> DataFrame:
    """Slices written less than ``ttl`` seconds ago, the safety net for windows no trim reaches."""
    return slices.filter(F.lit(as_of_epoch) - written_at < F.lit(ttl))


def point_rates(points: DataFrame) -> DataFrame:
    """A chart's two lines: the rate and the bots' part of it."""
    return points.select("t", "rate", bot_rate(F.col("rate"), F.col("bot"), F.col("total")).alias("bot_rate"))


def window_view(merged: DataFrame, shown: int = TOP_WIKIS_SHOWN) -> DataFrame:
    """
    What a live view shows of a window: rate, total, bot share, number of active wikis and
    the first ``shown`` of them with their length relative to the longest bar.
    """
    wikis = F.col("edits_per_wiki")
    bars = F.transform(
        F.slice(wikis, 1, shown),
        lambda w: F.struct(
            w["key"].alias("wiki"), w["count"].alias("count"),
            (w["count"] * 100.0 / wikis[0]["count"]).alias("bar_percent"),
        ),
    )
    bot = F.col("bot_vs_human.bot")
    return merged.select(
        "window_start",
        F.col("edits_per_second").alias("rate"),
        F.col("total_edits").alias("total"),
        share_percent(bot, bot + F.col("bot_vs_human.human")).alias("bot_percent"),
        F.size(wikis).alias("active_wikis"),
        bars.alias("wikis"),
    )


# -- top editors --------------------------------------------------------------

def window_top_editors(events: DataFrame, ts: Column, size: int, k: int = TOP_EDITORS) -> DataFrame:
    """Exact top editors per window, from all users of all partitions."""
    keyed = normalize(events).select(window_start(ts, size).alias("window_start"), "user")
    return top_k_per_group(
        user_counts(keyed, ["window_start"]), ["window_start"], "count", "user", k, rank="rank"
    )


def window_top_editors_from_slices(events: DataFrame, ts: Column, size: int, k: int = TOP_EDITORS) -> DataFrame:
    """
    Top editors as readers of slices see them: each partition's own top ``k``, added up.
    Lossy by design; a user just below the cut in every partition is missed.
    """
    keyed = normalize(events).select(
        window_start(ts, size).alias("window_start"),
        F.col("kafka_partition").alias("partition"),
        "user",
    )
    by_partition = user_counts(keyed, ["window_start", "partition"])
    cut = top_k_per_group(by_partition, ["window_start", "partition"], "count", "user", k)
    merged = cut.groupBy("window_start", "user").agg(F.sum("count").alias("count"))
    return top_k_per_group(merged, ["window_start"], "count", "user", k, rank="rank")


def editor_states(events: DataFrame, ts: Column, size: int, tracked: int = EDITORS_TRACKED) -> DataFrame:
    """
    Per window and partition a mergeable state of its editors' counts, of a size that does not depend on
    their number: ``window_start, partition, edits, editors``.
    """
    keyed = normalize(events).select(
        window_start(ts, size).alias("window_start"), F.col("kafka_partition").alias("partition"), "user")
    return keyed.groupBy("window_start", "partition").agg(F.count("*").alias("edits"), heavy_state("user", tracked).alias("editors"))


def merged_top_editors(states: DataFrame, k: int = TOP_EDITORS, tracked: int = EDITORS_TRACKED) -> DataFrame:
    """
    Top editors per window from the states of its partitions, whoever wrote them: ``window_start, rank, user,
    count, error``. Counts are off by ``error`` at most, which is 0 as long as a window has no more editors than
    its states track; unlike lists that are cut before they are merged, no editor with more than that is missed.
    """
    merged = states.groupBy("window_start").agg(F.sum("edits").alias("edits"), heavy_merge("editors", tracked).alias("editors"))
    items = merged.select("window_start", "edits", heavy_items("editors", tracked).alias("items"))
    ranked_ = items.select("window_start", heavy_error(F.col("items"), F.col("edits"), tracked).alias("error"),
                           F.posexplode(F.slice("items", 1, k)).alias("place", "top"))
    return ranked_.select("window_start", (F.col("place") + 1).alias("rank"), F.col("top.item").alias("user"),
                          F.col("top.count").alias("count"), "error")


# -- versions -----------------------------------------------------------------

def latest_version(table: DataFrame, keys: Sequence[str], version: str = "version") -> DataFrame:
    """
    The newest write of every key. Writers only append (key, version, value); a replay
    appends or overwrites its own version, so a corrected value wins and nothing doubles.
    """
    rest = [c for c in table.columns if c not in keys and c != version]
    newest = F.max_by(F.struct(*rest), F.col(version))
    return table.groupBy(*keys).agg(newest.alias("_row"), F.max(version).alias(version)).select(
        *keys, "_row.*", version
    )


def window_changes(versions: DataFrame) -> DataFrame:
    """
    What a client following the windows is sent: each version whose total differs from
    the one before it, the first version included.
    """
    over = Window.partitionBy("window_start").orderBy("version")
    before = F.lag("total").over(over)
    return versions.withColumn("previous", before).filter(
        F.col("previous").isNull() | (F.col("previous") != F.col("total"))
    )


def adds_up() -> Column:
    """True where every breakdown of a summary adds up to its total."""

    def added(items: str) -> Column:
        return F.aggregate(F.col(items), F.lit(0).cast("long"), lambda s, x: s + x["count"])

    total = F.col("total_edits")
    return (
        (added("edits_per_wiki") == total)
        & (added("edit_types") == total)
        & (F.col("bot_vs_human.bot") + F.col("bot_vs_human.human") == total)
    )
