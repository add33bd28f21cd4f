import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import rollup
from tallybrook.plans import analytics
from tallybrook.plans.analytics import ChartSpec, Refused
from tallybrook.settings import BUCKETS, DEFAULT_BUCKET, MAX_LIMIT, MAX_POINTS, RANGES, RETENTION_DAYS
from tallybrook.sources.tables import dedup, expired, retained

EDITS = ("ingested_at timestamp_ntz, wiki string, type string, user string, bot boolean, "
         "kafka_partition int, kafka_offset long")
DAY = dt.datetime(2024, 1, 10)
AS_OF = "2024-01-10 12:00:00"


def edits(spark, *rows):
    """(time, wiki, type, user, bot[, partition, offset])"""
    full = [(*r[:5], *(r[5:] or (0, i))) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, EDITS)


def clock(text):
    return dt.datetime.combine(DAY.date(), dt.time.fromisoformat(text))


def table(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in rollup.with_estimates(df).collect())


COUNTS = ("edits", "bot_edits", "new_pages", "editors")


def test_minute_rollup(spark):
    df = rollup.rollup_minute(edits(
        spark, (clock("10:00:05"), "en", "edit", "a", True), (clock("10:00:20"), "en", "new", "b", False),
        (clock("10:00:59"), "en", "edit", "a", True), (clock("10:01:00"), "en", "edit", "a", False)))
    assert table(df, "minute", *COUNTS) == [
        (clock("10:00:00"), 3, 2, 1, 2), (clock("10:01:00"), 1, 0, 0, 1)]


def test_distinct_editors_do_not_add_but_merge(spark):
    minute = rollup.rollup_minute(edits(
        spark, (clock("10:00:01"), "en", "edit", "alice", False),
        (clock("10:00:02"), "en", "edit", "bob", False), (clock("10:01:00"), "en", "edit", "alice", False)))
    assert table(minute, "editors") == [(1,), (2,)]
    assert table(rollup.rollup_read(minute, ["wiki"]), "editors") == [(2,)]


def test_null_users_are_no_editors_but_empty_names_are(spark):
    at = clock("10:00:00")
    df = rollup.rollup_minute(edits(
        spark, (at, "en", "edit", None, False), (at, "en", "edit", None, False), (at, "en", "edit", "alice", False)))
    assert table(df, "edits", "editors") == [(3, 1)]
    df = rollup.rollup_minute(edits(spark, (at, "en", "edit", "", False), (at, "en", "edit", None, False)))
    assert table(df, "edits", "editors") == [(2, 1)]


def test_chained_day(spark):
    day = rollup.rollup_day(rollup.rollup_minute(edits(
        spark, (clock("10:00:05"), "en", "edit", "alice", True), (clock("23:59:59"), "en", "new", "alice", False),
        (clock("00:00:01") + dt.timedelta(days=1), "en", "edit", "bob", False))))
    assert table(day, "day", *COUNTS) == [
        (dt.date(2024, 1, 10), 2, 1, 1, 1), (dt.date(2024, 1, 11), 1, 0, 0, 1)]


def test_day_is_the_sum_of_its_minutes(spark):
    rows = [(clock("00:00:00") + dt.timedelta(seconds=977 * i), f"w{i % 3}", "new" if i % 7 == 0 else "edit",
             f"u{i * i % 11}", i % 4 == 1) for i in range(88)]
    minute = rollup.rollup_minute(edits(spark, *rows))
    got = {r["wiki"]: tuple(r)[2:] for r in rollup.with_estimates(rollup.rollup_day(minute)).collect()}
    for wiki in ("w0", "w1", "w2"):
        own = [r for r in rows if r[1] == wiki]
        assert got[wiki] == (len(own), sum(r[4] for r in own), sum(r[2] == "new" for r in own), len({r[3] for r in own}))


def test_unmerged_parts_read_as_one(spark):
    part = rollup.rollup_minute(edits(spark, (clock("10:00:05"), "en", "edit", "a", False)))
    both = part.unionByName(part)
    assert both.count() == 2
    assert table(rollup.rollup_read(both, ["minute", "wiki"]), "edits", "editors") == [(2, 1)]


def test_redelivery(spark):
    row = (clock("10:00:05"), "en", "edit", "a", False, 3, 42)
    copies = edits(spark, row, row)
    assert dedup(copies).count() == 1
    assert table(rollup.rollup_minute(copies), "edits", "editors") == [(2, 1)]
    assert table(rollup.rollup_minute(dedup(copies)), "edits", "editors") == [(1, 1)]


def test_sketch_is_exact_to_its_size_and_close_beyond(spark):
    for n, margin in ((60_000, 0), (200_000, 0.02)):
        parts = spark.range(n * 2).select(
            F.lit("en").alias("wiki"), (F.col("id") % 8).alias("part"),
            F.concat(F.lit("u"), F.col("id") % n).alias("user"))
        from tallybrook.functions.sketches import editors_estimate, editors_merge, editors_state
        states = parts.groupBy("part").agg(editors_state(F.col("user")).alias("s"))
        got = states.agg(editors_estimate(editors_merge(F.col("s")))).first()[0]
        assert abs(got - n) <= margin * n


def test_top_editors_counts_messages_once(spark):
    at = clock("11:00:00")
    df = edits(spark, (at, "en", "edit", "alice", True, 3, 42), (at, "en", "edit", "alice", True, 3, 42),
               (at, "de", "edit", "alice", False, 3, 43), (at, "fr", "edit", "bob", False, 1, 7),
               (at, "fr", "edit", None, False, 1, 8))
    got = [tuple(r) for r in analytics.top_editors(df, "24h", 10, AS_OF).collect()]
    assert got == [("alice", 2, 1, 2), ("bob", 1, 0, 1)]


def test_top_wikis(spark):
    at = clock("11:00:00")
    df = edits(spark, *[(at, w, "edit", "u", False) for w in ["en"] * 3 + ["de"] * 5 + ["fr"]])
    got = analytics.top_wikis(rollup.rollup_minute(df), "24h", 2, AS_OF).collect()
    assert [(r["wiki"], r["edits"]) for r in got] == [("de", 5), ("en", 3)]


def test_range_cut(spark):
    now = dt.datetime.fromisoformat(AS_OF)
    df = edits(spark, (now - dt.timedelta(seconds=60), "en", "edit", "u", False),
               (now - dt.timedelta(hours=2), "en", "edit", "u", False))
    minute = rollup.rollup_minute(df)
    points = analytics.timeline(minute, rollup.rollup_day(minute), "1h", "1m", AS_OF).collect()
    assert sum(p["edits"] for p in points) == 1
    # The lower edge belongs to the range.
    edge = edits(spark, (now - dt.timedelta(hours=1), "en", "edit", "u", False))
    assert analytics.since(edge, "ingested_at", 3600, AS_OF).count() == 1


def test_grid_takes_only_points_of_the_chart(spark):
    points = spark.createDataFrame([(t, 1) for t in range(0, 2_000_000_000, 10_000_000)], "t long, edits long")
    assert analytics.timeline_grid(points, "1h", "5m", AS_OF).count() == 13


def test_grid_shows_gaps_as_null(spark):
    at = clock("11:30:00")
    minute = rollup.rollup_minute(edits(spark, (at, "en", "edit", "u", False)))
    points = analytics.timeline(minute, rollup.rollup_day(minute), "1h", "5m", AS_OF)
    grid = analytics.timeline_grid(points, "1h", "5m", AS_OF).collect()
    assert len(grid) == 13 and [g["edits"] for g in grid if g["edits"] is not None] == [1]
    assert [g["t"] for g in grid] == sorted(g["t"] for g in grid)


def test_charts_by_their_points():
    """Every pair is drawn or refused by its number of points and by what the rollup keeps."""
    for range_, seconds in RANGES.items():
        for bucket, step in BUCKETS.items():
            kept = step == 86_400 or seconds <= RETENTION_DAYS["edits_1m"] * 86_400
            if 1 <= seconds // step <= MAX_POINTS and kept:
                assert ChartSpec(range_, bucket).seconds == seconds
            else:
                with pytest.raises(Refused):
                    ChartSpec(range_, bucket)
    for range_, bucket in (("2h", "1m"), ("1h", "1H"), ("7D", "1h")):
        with pytest.raises(Refused, match="choose from"):
            ChartSpec(range_, bucket)
    for range_, bucket in DEFAULT_BUCKET.items():
        ChartSpec(range_, bucket)


def test_limits_at_their_edges():
    assert [analytics.checked_limit(n) for n in (1, MAX_LIMIT)] == [1, MAX_LIMIT]
    for n in (1 - 1, MAX_LIMIT + 1):
        with pytest.raises(Refused):
            analytics.checked_limit(n)


def test_editors_only_as_long_as_raw_is_kept(spark):
    with pytest.raises(Refused, match="7 days in edits"):
        analytics.top_editors(edits(spark, (clock("10:00:00"), "en", "edit", "u", False)), "30d", 5, AS_OF)
    assert analytics.editor_range("90d") == "7d" and analytics.editor_range("24h") == "24h"


def test_freshness(spark):
    now = dt.datetime.fromisoformat(AS_OF)
    df = edits(spark, (now - dt.timedelta(milliseconds=1500), "en", "edit", "u", False))
    assert analytics.freshness(df, AS_OF).first()[0] == 1.5
    assert analytics.freshness(df.limit(0), AS_OF).first()[0] is None
    old = edits(spark, (now - dt.timedelta(days=3), "en", "edit", "u", False))
    assert analytics.freshness(old, AS_OF).first()[0] is None


def test_history_report(spark):
    at = clock("11:30:00")
    df = edits(spark, (at, "en", "new", "u", True), (at, "de", "edit", "v", False))
    minute = rollup.rollup_minute(df)
    parts = analytics.history_report(minute, rollup.rollup_day(minute), df, "30d", AS_OF)
    tiles = parts["tiles"].first()
    assert tuple(tiles) == (2, 50.0, 1, "de", 1)
    assert parts["timeline"].count() == 31 and parts["top_editors"].count() == 2
    assert {r["range"] for r in parts["top_editors"].collect()} == {"7d"}
    empty = analytics.history_report(minute.limit(0), rollup.rollup_day(minute.limit(0)), df.limit(0), "24h", AS_OF)
    assert tuple(empty["tiles"].first()) == (0, None, 0, None, None)


def test_retention(spark):
    now = dt.datetime.fromisoformat(AS_OF)
    df = edits(spark, *[(now - dt.timedelta(days=d), "en", "edit", "u", False) for d in (1, 7, 8)])
    assert retained(df, "edits", "ingested_at", AS_OF).count() == 1
    assert df.filter(expired(df, "ingested_at", 7, AS_OF)).count() == 2
    assert df.filter(expired(df, "ingested_at", None, AS_OF)).count() == 0


def test_filters_reach_the_scan(spark, data):
    from tallybrook.plans.catalog import QUERIES

    def scan(name):
        return QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()

    for name in ("range_filter", "timeline_1h", "top_editors", "freshness"):
        assert "GreaterThanOrEqual(ts" in scan(name), name
    assert "ReadSchema: struct<ts:timestamp_ntz>" in scan("freshness")
    assert "TakeOrderedAndProject" in scan("top_editors")
    assert "Expand" not in scan("top_editors") and "SortAggregate" not in scan("top_editors")
