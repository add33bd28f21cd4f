import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallybrook.functions.clock import window_start
from tallybrook.operators import lateness, windows
from tallybrook.operators.ordered import previous, running_max
from tallybrook.operators.topk import top_k_per_group
from tallybrook.schemas import SLICE

EDIT = "ts double, wiki string, type string, user string, bot boolean, kafka_partition int, kafka_offset long"


def edits(spark, rows, partition=0):
    full = [
        (float(r[0]), *(r[1:5] if len(r) >= 5 else ("w", "edit", "u", False)),
         r[5] if len(r) > 5 else partition, i)
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(full, EDIT).withColumn("at", F.timestamp_seconds("ts"))


def at(*seconds):
    return [(s,) for s in seconds]


def test_alignment(spark):
    """On the edges, just below them, and anywhere."""
    rng = random.Random(12)
    moments = [k * 7 + d for k in (0, 1, 99, 250_000_000) for d in (0, 6.999, 3)] + [rng.uniform(0, 2e9) for _ in range(50)]
    got = edits(spark, at(*moments)).select("ts", window_start(F.col("at"), 7).alias("start")).collect()
    assert len(got) == len(moments) and all(r["start"] == int(r["ts"] // 7) * 7 for r in got)


def one_summary(spark, rows, size=5):
    return windows.window_slices(edits(spark, rows), F.col("at"), size).collect()


def test_placeholders(spark):
    (s,) = one_summary(spark, [(1, None, "", None, None)])
    assert [tuple(x) for x in s["edits_per_wiki"]] == [("unknown", 1)]
    assert [tuple(x) for x in s["edit_types"]] == [("unknown", 1)]
    assert [tuple(x) for x in s["top_editors"]] == [("anonymous", 1)]
    assert tuple(s["bot_vs_human"]) == (0, 1)


def test_editors_are_cut_to_the_first(spark):
    """As many as are kept, by count and name, out of twice as many."""
    k = windows.TOP_EDITORS
    counts = {f"editor-{n:02}": 1 + n // 2 for n in range(2 * k)}
    rows = [(3, "w", "edit", user, False) for user, n in counts.items() for _ in range(n)]
    (s,) = one_summary(spark, rows, 20)
    first = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]
    assert [tuple(x) for x in s["top_editors"]] == first
    assert (s["total_edits"], s["edits_per_second"]) == (sum(counts.values()), round(sum(counts.values()) / 20, 2))


def test_breakdowns_add_up_and_order_does_not_matter(spark):
    rng = random.Random(7)
    rows = [(rng.random() * 30, f"w{rng.randrange(3)}", rng.choice(["edit", "new"]),
             f"u{rng.randrange(9)}", rng.random() < 0.3, rng.randrange(3)) for _ in range(300)]
    first = windows.window_slices(edits(spark, rows), F.col("at"), 5)
    assert first.filter(~windows.adds_up()).count() == 0
    rng.shuffle(rows)
    again = windows.window_slices(edits(spark, rows), F.col("at"), 5)
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))


def slice_row(start, partition, total, bot=0, wikis=(), users=(), size=5):
    values = {
        "window_start": start, "window_end": start + size, "partition": partition, "total_edits": total,
        "edits_per_second": total / size, "edits_per_wiki": list(wikis), "bot_vs_human": (bot, total - bot),
        "edit_types": [("edit", total)], "top_editors": list(users), "written_at": None,
    }
    return tuple(values[name] for name in SLICE.names)


def slices(spark, *rows):
    return spark.createDataFrame(list(rows), SLICE)


@pytest.mark.parametrize("seed", range(3))
def test_merge_adds_up_generated_slices(spark, seed):
    """Totals, bots, wikis and types are sums; the rate is that of the merged total, whatever the slices say."""
    rng = random.Random(seed)
    rows, want = [], {}
    for start in range(0, 40, 10):
        for partition in range(rng.randrange(1, 6)):
            wikis = [(w, rng.randrange(1, 90)) for w in rng.sample("abcdef", rng.randrange(1, 5))]
            total = sum(n for _, n in wikis)
            bot = rng.randrange(total + 1)
            rows.append(slice_row(start, partition, total, bot, wikis, size=10))
            held = want.setdefault(start, [0, 0, 0, {}])
            held[0] += total
            held[1] += bot
            held[2] += 1
            for w, n in wikis:
                held[3][w] = held[3].get(w, 0) + n
    data = slices(spark, *rows)
    merged = {m["window_start"]: m for m in windows.merge_slices(data).collect()}
    points = {p["t"]: p for p in windows.window_points(data).collect()}
    assert set(merged) == set(points) == set(want)
    for start, (total, bot, count, wikis) in want.items():
        m, p = merged[start], points[start]
        assert (m["total_edits"], m["partitions"], m["window_end"], tuple(m["bot_vs_human"])) == (total, count, start + 10, (bot, total - bot))
        assert (m["edits_per_second"], p["rate"]) == (round(total / 10, 2),) * 2 and (p["total"], p["bot"]) == (total, bot)
        assert [tuple(x) for x in m["edits_per_wiki"]] == sorted(wikis.items(), key=lambda x: (-x[1], x[0]))
        assert [tuple(x) for x in m["edit_types"]] == [("edit", total)]


def test_equal_counts_of_two_slices_go_by_name(spark):
    users = [("delta", 4), ("alpha", 4), ("omega", 9)]
    (m,) = windows.merge_slices(slices(spark, *[slice_row(30, p, 4, users=[u]) for p, u in enumerate(users)])).collect()
    assert [tuple(x) for x in m["top_editors"]] == [("omega", 9), ("alpha", 4), ("delta", 4)]


def test_an_even_user_is_first_only_when_counted_whole(spark):
    """Six partitions, each with k users of its own who are all ahead of the one seen everywhere."""
    k, rows = windows.TOP_EDITORS, []
    for p in range(6):
        for place in range(k):
            rows += [(2, "w", "edit", f"local-{p}-{place}", False, p)] * (3 + place)
        rows += [(2, "w", "edit", "everywhere", False, p)] * 2
    data = edits(spark, rows)
    exact = windows.window_top_editors(data, F.col("at"), 5).collect()
    assert [(r["user"], r["count"]) for r in exact if r["rank"] == 1] == [("everywhere", 12)]
    lossy = windows.window_top_editors_from_slices(data, F.col("at"), 5).collect()
    assert all(r["user"].startswith("local") for r in lossy)


def test_merged_states_find_what_cut_lists_miss(spark):
    """The editor who is just below the cut of every partition, from states; exact while they track all."""
    k, rows = windows.TOP_EDITORS, []
    for p in range(6):
        for place in range(k):
            rows += [(2, "w", "edit", f"local-{p}-{place}", False, p)] * (3 + place)
        rows += [(2, "w", "edit", "everywhere", False, p)] * 2
    data = edits(spark, rows)
    states = windows.editor_states(data, F.col("at"), 5)
    got = windows.merged_top_editors(states).orderBy("rank").collect()
    exact = windows.window_top_editors(data, F.col("at"), 5).orderBy("rank").collect()
    assert [(r["rank"], r["user"], r["count"], r["error"]) for r in got] == [(r["rank"], r["user"], r["count"], 0) for r in exact]


def test_merged_states_are_within_their_error(spark):
    """More editors than are tracked: counts are off by the stated error at most, and frequent ones are found."""
    rows = spark.range(60_000).select(
        F.lit(0.0).alias("ts"), F.lit("w").alias("wiki"), F.lit("edit").alias("type"), F.lit(False).alias("bot"),
        (F.col("id") % 5).cast("int").alias("kafka_partition"), F.col("id").alias("kafka_offset"),
        F.when(F.col("id") % 10 < 3, F.concat(F.lit("busy"), (F.col("id") % 3).cast("string"))).otherwise(
            F.concat(F.lit("u"), F.col("id").cast("string"))).alias("user")).withColumn("at", F.timestamp_seconds("ts"))
    true = {r["user"]: r["count"] for r in rows.groupBy("user").count().collect()}
    found = windows.merged_top_editors(windows.editor_states(rows, F.col("at"), 5, 200), 3, 200).collect()
    assert {r["user"] for r in found} == {"busy0", "busy1", "busy2"}
    assert all(0 < r["error"] < 2000 and abs(r["count"] - true[r["user"]]) <= r["error"] for r in found)


def test_newest_windows_of_slices(spark):
    starts = [1000 + 50 * i for i in range(9)]
    data = slices(spark, *[slice_row(s, p, 1 + p, size=50) for s in starts for p in range(1 + s % 3)])
    for n in (1, 4, 9, 30):
        kept = windows.trim(data, n)
        assert {r["window_start"] for r in kept.collect()} == set(starts[-n:])
        assert [r["t"] for r in windows.window_history(data, limit=n).collect()] == starts[-n:]
    for limit in (0, windows.HISTORY_WINDOWS + 1):
        with pytest.raises(ValueError, match="windows"):
            windows.window_history(data, limit=limit)
    assert [r["window_start"] for r in windows.window_latest(data).collect()] == starts[-1:]


def test_window_view(spark):
    data = slices(spark, slice_row(100, 0, 20, 5, [(f"w{i}", 20 - i) for i in range(10)]))
    view = windows.window_view(windows.merge_slices(data)).first()
    assert (view["rate"], view["total"], view["bot_percent"], view["active_wikis"]) == (4.0, 20, 25.0, 10)
    assert len(view["wikis"]) == 8 and tuple(view["wikis"][1]) == ("w1", 19, 95.0)


def test_ttl(spark):
    data = spark.createDataFrame([(1, 100), (2, 1000)], "window_start long, written_at long")
    kept = windows.within_ttl(data, F.col("written_at"), 1300).collect()
    assert [r["window_start"] for r in kept] == [2]


def test_the_newest_version_of_each_key_wins(spark):
    rng = random.Random(3)
    rows = [(s, p, v, rng.randrange(99)) for s in (50, 55) for p in (0, 1, 4) for v in range(1, rng.randrange(2, 5))]
    table = spark.createDataFrame(rows, "window_start long, partition int, version long, total long")
    replayed = table.unionByName(table)
    latest = windows.latest_version(replayed, ["window_start", "partition"]).collect()
    assert {(r["window_start"], r["partition"]): (r["version"], r["total"]) for r in latest} == {
        (s, p): (v, n) for s, p, v, n in rows}


def test_changes_skip_equal_totals(spark):
    rows = [(100, 1, 5), (100, 2, 5), (100, 3, 8), (105, 3, 2)]
    versions = spark.createDataFrame(rows, "window_start long, version long, total long")
    sent = windows.window_changes(versions).collect()
    assert sorted((r["window_start"], r["version"]) for r in sent) == [(100, 1), (100, 3), (105, 3)]


# -- lateness -----------------------------------------------------------------

def read_one_by_one(rows, size, grace):
    """(offset, window, late) of (partition, clock) rows in order, their partitions' marks and the open windows' lowest offsets."""
    marks, out = {}, []
    for offset, (partition, clock) in enumerate(rows):
        start = clock // size * size
        before = marks.get(partition)
        out.append((partition, offset, start, before is not None and start + size + grace <= before))
        marks[partition] = clock if before is None else max(before, clock)
    return out, marks


def generated(seed, count=400):
    """Clocks of three partitions, one of which has most rows, moving on with jumps and running behind."""
    rng = random.Random(seed)
    clock, rows = 10_000, []
    for _ in range(count):
        clock += rng.choice([0, 1, 2, 2, 40 if seed % 2 else 3])
        rows.append((rng.choice([0, 0, 0, 1, 2]), max(1, clock - rng.choice([0, 0, 3, 12, 30]))))
    return rows


def clocks(spark, rows):
    return edits(spark, [(clock, "w", "edit", "u", False, partition) for partition, clock in rows])


@pytest.mark.parametrize("seed, chunk", [(0, 1), (1, 7), (2, 50), (3, 100_000)])
def test_lateness_equals_reading_one_by_one(spark, seed, chunk):
    """At any chunk: an edit on a chunk's edge is judged by all that came before it."""
    size, grace, rows = 7, 4, generated(seed)
    data, cut = clocks(spark, rows), F.floor(F.col("kafka_offset") / chunk)
    judged, marks = read_one_by_one(rows, size, grace)
    late = lateness.late_events(data, F.col("at"), size, grace, cut).collect()
    assert sorted((r["kafka_partition"], r["kafka_offset"], r["window_start"]) for r in late) == sorted(
        x[:3] for x in judged if x[3])
    want = {}
    for partition, _, start, is_late in judged:
        place = 0 if is_late else 1 if start + size + grace <= marks[partition] else 2
        want.setdefault(partition, [0, 0, 0])[place] += 1
    got = lateness.disposition(data, F.col("at"), size, grace, cut).collect()
    assert {r["kafka_partition"]: [r["late_events"], r["closed_events"], r["open_events"]] for r in got} == want


@pytest.mark.parametrize("seed", range(3))
def test_restart_offset_is_the_first_an_open_window_needs(spark, seed):
    size, grace, rows = 7, 4, generated(seed)
    judged, marks = read_one_by_one(rows, size, grace)
    got = {r["kafka_partition"]: (r["safe"], r["end_offset"]) for r in lateness.restart_offsets(
        clocks(spark, rows), F.col("at"), size, grace).collect()}
    for partition, mark in marks.items():
        own = [x for x in judged if x[0] == partition]
        needed = [offset for _, offset, start, _ in own if start + size + grace > mark]
        assert got[partition] == (min(needed), own[-1][1] + 1)


@pytest.mark.parametrize("past, closed", [(-0.001, 0), (0, 1)])
def test_a_window_closes_on_its_end_plus_grace(spark, past, closed):
    end, grace = 7 * 12, 2.5
    counts = spark.createDataFrame([(0, end - 7, 3)], "kafka_partition int, window_start long, events long")
    marks = spark.createDataFrame([(0, end + grace + past)], "kafka_partition int, s double").select(
        "kafka_partition", F.timestamp_seconds("s").alias("watermark"))
    assert lateness.closed_windows(counts, marks, 7, grace).count() == closed


@pytest.mark.parametrize("seed, cap", [(0, None), (1, 3), (2, 1), (3, 0)])
def test_gaps_are_filled_up_to_the_cap(spark, seed, cap):
    rng = random.Random(seed)
    size, starts = 5, {p: sorted(rng.sample(range(0, 200_000, 5), 25) + [0, 5]) for p in (0, 1)}
    starts[0] += [200_000 + 5 * k for k in range(4)]
    counts = {(p, s): rng.randrange(1, 9) for p, own in starts.items() for s in set(own)}
    want = {}
    for p in starts:
        before = None
        for s in sorted({s for q, s in counts if q == p}):
            gap = [] if before is None else list(range(before + size, s, size))
            kept = gap if cap is None else gap[len(gap) - min(cap, len(gap)):]
            want.update({(p, g): (0, 0) for g in kept})
            want[p, s] = (counts[p, s], len(gap) - len(kept))
            before = s
    df = spark.createDataFrame([(p, s, n) for (p, s), n in counts.items()], "kafka_partition int, window_start long, events long")
    got = {(r[0], r[1]): (r[2], r[3]) for r in lateness.fill_gaps(df, size, cap).collect()}
    assert got == want


def test_what_is_before_the_first_window_is_flagged(spark):
    rows = [(0, 700), (1, 40), (0, 699), (0, 713), (1, 41), (1, 34)]
    flagged = lateness.apply_origin(clocks(spark, rows), F.col("at"), 7).filter("before_origin").collect()
    assert sorted(r["kafka_offset"] for r in flagged) == [2, 5]


def test_watermark_is_the_highest_clock_so_far(spark):
    rows = generated(5, 120)
    _, marks = read_one_by_one(rows, 7, 0)
    got = lateness.partition_watermark(clocks(spark, rows), F.col("at")).collect()
    assert {r["kafka_partition"]: int(r["watermark"].replace(tzinfo=dt.timezone.utc).timestamp()) for r in got} == marks


def test_densify_fills_between_first_and_last(spark):
    """Over several days, so that the grid is made in parts."""
    starts = {0: [80_000, 90_000, 260_000], 1: [86_000]}
    counts = spark.createDataFrame([(p, s, 2) for p, own in starts.items() for s in own],
                                   "kafka_partition int, window_start long, events long")
    got = {(r[0], r[1]): r[2] for r in lateness.densify(counts, 500).collect()}
    assert got == {(p, s): 2 if s in own else 0 for p, own in starts.items() for s in range(own[0], own[-1] + 1, 500)}


def test_clock_falls_back_to_arrival(spark):
    data = spark.createDataFrame([(1, None), (1, 0), (1, -1), (1, 7)], "a int, p int").select(
        F.timestamp_seconds("a").alias("ingested_at"), F.timestamp_seconds("p").alias("event_time"))
    got = data.select(F.unix_seconds(windows.event_clock(data, "event"))).collect()
    assert [r[0] for r in got] == [1, 1, 1, 7]
    with pytest.raises(ValueError):
        windows.event_clock(data, "wall")


# -- ordered helpers ----------------------------------------------------------

@pytest.mark.parametrize("chunk", [1, 3, 100])
def test_ordered_columns_do_not_depend_on_chunks(spark, chunk):
    rng = random.Random(chunk)
    rows = [(k, i, rng.randrange(50)) for k in "ab" for i in range(40) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "k string, i long, v long")
    cut = F.floor(F.col("i") / chunk)
    best = running_max(df, ["k"], "i", "v", cut, name="best")
    prior = running_max(best, ["k"], "i", "v", cut, name="prior", include_current=False)
    last = previous(prior, ["k"], "i", "v", cut, name="last")
    got = {(r["k"], r["i"]): (r["best"], r["prior"], r["last"]) for r in last.collect()}
    for k in "ab":
        seen = []
        for _, i, v in [r for r in rows if r[0] == k]:
            assert got[(k, i)] == (max(seen + [v]), max(seen, default=None), seen[-1] if seen else None)
            seen.append(v)


def test_top_k_on_a_hot_group(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("g"),
        (F.col("id") % 977).alias("n"), F.col("id").cast("string").alias("name"))
    top = top_k_per_group(df, ["g"], "n", "name", 5)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    hot = sorted(((-r["n"], r["name"]) for r in df.filter("g = 'hot'").collect()))[:5]
    assert sorted((-r["n"], r["name"]) for r in top.filter("g = 'hot'").collect()) == hot
