"""Windows as the flush after each poll emits them, against reading the polls one after the other."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tallybrook.operators import lateness, series
from tallybrook.plans.catalog import QUERIES
from tallybrook.plans.oracle import ORACLES

SCHEMA = "kafka_partition int, kafka_offset long, at timestamp, poll long"


def polled(seed, n=400):
    """(partition, offset, clock, poll) with clocks out of order and jumps; offsets may go back from poll to poll."""
    rng, rows, clock = random.Random(seed), [], 3_000
    for offset in range(n):
        clock += rng.choice([0, 1, 1, 2, 9]) if rng.random() > 0.02 else rng.choice([150, 400])
        rows.append((rng.choice([0, 0, 1, 2]), offset, max(1, clock - rng.choice([0, 0, 2, 13, 40])), offset // 12))
    return [(p, -o if seed % 2 else o, clock, poll) for p, o, clock, poll in rows]


def read_polls(rows, size, grace, cap):
    """{(partition, window): [events, late events, emitted by, status]}"""
    fates = {}
    for partition in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == partition]
        polls = sorted({r[3] for r in own})
        first = min((r for r in own if r[3] == polls[0]), key=lambda r: r[1])
        origin = before = first[2] // size * size - size
        mark = 0
        for poll in polls:
            for _, _, clock, _ in (r for r in own if r[3] == poll):
                start = clock // size * size
                fates.setdefault((partition, start), [0, 0, None, None])[start <= before] += 1
                mark = max(mark, clock)
            through = max(origin, (mark - grace) // size * size - size)
            start = before + size if cap is None else max(before + size, through - (cap - 1) * size)
            for window in range(start, through + size, size):
                fates.setdefault((partition, window), [0, 0, None, None])[2] = poll
            before = through
        for (p, window), fate in fates.items():
            if p == partition:
                fate[3] = "emitted" if fate[2] is not None else "dropped" if window <= before else "open"
    return fates


def frame(spark, rows):
    # Rows without a clock or a poll meet no flush.
    rows = [(p, o, dt.datetime.fromtimestamp(clock, dt.timezone.utc), poll) for p, o, clock, poll in rows]
    return spark.createDataFrame([*rows, (0, 90_000, None, 1), (None, 90_001, rows[0][2], 1), (0, 90_002, rows[0][2], None)], SCHEMA)


@pytest.mark.parametrize("seed, cap, chunk", [(0, None, 1), (1, None, 10_000), (2, 3, 5), (3, 1, 10_000)])
def test_flushes_equal_reading_poll_by_poll(spark, seed, cap, chunk):
    size, grace, rows = 7, 4, polled(seed)
    want = read_polls(rows, size, grace, cap)
    of = (frame(spark, rows), F.col("at"), F.col("poll"), size, grace, cap, chunk)
    got = {(r[0], r[1]): list(r)[2:] for r in lateness.window_fates(*of).collect()}
    assert got == want
    shown = {(r[0], r[1]): list(r)[2:] for r in lateness.emitted_windows(*of).collect()}
    assert shown == {k: [n, by, status] for k, (n, _, by, status) in want.items() if n or by is not None}
    sums = {r[0]: list(r)[1:] for r in lateness.event_fates(*of).collect()}
    for partition in {r[0] for r in rows}:
        own = [f for (p, _), f in want.items() if p == partition]
        each = [sum(f[0] for f in own if f[3] == s) for s in ("emitted", "dropped", "open")]
        assert sums[partition] == [sum(f[1] for f in own), *each] and sum(sums[partition]) == sum(r[0] == partition for r in rows)


# (event_id, minutes after midnight at which it arrives); its clock is event_id * 7919 % 13 minutes earlier, 12 for 6.
ARRIVALS = ((13, 0), (26, 2), (39, 31), (52, 39), (6, 42), (65, 200), (78, 201))
MIDNIGHT = int(dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc).timestamp())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Events of one partition: a quiet half hour, an event whose window is gone, and a quiet stretch beyond the gap cap."""
    path = tmp_path_factory.mktemp("events")
    rows = [(n, dt.datetime(2024, 1, 10) + dt.timedelta(minutes=m), 7, "click", 1.0, '{"k": 6}') for n, m in ARRIVALS]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/events.parquet")
    return str(path)


def test_late_disposition_counts_what_flushes_left(spark, folder):
    assert QUERIES["late_disposition"](spark, folder).first().asDict() == {
        "kafka_partition": 0, "late_events": 1, "emitted_events": 4, "dropped_events": 0, "open_events": 2}


def test_gap_cap_drops_what_its_flush_leaves_out(spark, folder):
    """Quiet windows are emitted by the poll that closes them; a window with an event beyond the cap is dropped."""
    got = {((r["window_start"] - MIDNIGHT) // 60): (r["events"], r["emitted_by"] and r["emitted_by"] - MIDNIGHT // 600, r["status"])
           for r in QUERIES["window_gap_capped"](spark, folder).collect()}
    quiet = {m: (0, 3, "emitted") for m in range(0, 35, 5)} | {m: (0, 20, "emitted") for m in range(140, 200, 5)}
    assert got == quiet | {0: (2, 3, "emitted"), 30: (1, 3, "emitted"), 35: (1, None, "dropped"), 200: (2, None, "open")}


def test_emit_delay_has_every_emitted_window(spark, folder):
    """Quiet ones too: from the end of the window to the end of the poll that closed it."""
    got = {(r["window_start"] - MIDNIGHT) // 60: (r["written_at"] - MIDNIGHT, r["delay_seconds"])
           for r in QUERIES["emit_delay"](spark, folder).collect()}
    assert got == {m: (end * 60, (end - m - 5) * 60.0) for end, own in ((40, range(0, 35, 5)), (210, range(35, 200, 5))) for m in own}


def test_histogram_buckets_count_every_emitted_window(spark, folder):
    got = QUERIES["histogram_buckets"](spark, folder).orderBy("le").collect()
    assert [r["cumulative"] for r in got] == [0, 1, 3, 7, 11, 18, 30, 40, 40] and {r["kafka_partition"] for r in got} == {0}


def test_histogram_quantile_is_of_every_emitted_window(spark, folder):
    row = QUERIES["histogram_quantile"](spark, folder).first()
    assert row["kafka_partition"] == 0 and row["p99"] == pytest.approx(7200 + 7200 * (39.6 - 30) / 10)


def test_histogram_quantile_leaves_out_no_partition(spark):
    """The SQL's step after the buckets, and the operator, give a row to a partition whose buckets count nothing too."""
    inf = float("inf")
    rows = [(0, 60.0, 1), (0, 300.0, 100), (0, inf, 100), (1, 60.0, 0), (1, 300.0, 0), (1, inf, 0)]
    names, step = ["kafka_partition", "le", "cumulative"], ORACLES["histogram_quantile"].split("\nx AS (")[1]
    buckets = ", ".join(f"({p}, '{le}'::DOUBLE, {n})" for p, le, n in rows)
    sql = dict(duckdb.execute(f"WITH buckets({', '.join(names)}) AS (VALUES {buckets}),\nx AS ({step}").fetchall())
    got = dict(series.histogram_quantile(spark.createDataFrame(rows, names), 0.99, names[:1], "p99").collect())
    assert set(sql) == set(got) == {0, 1} and got[1] is None
    assert sql[0] == pytest.approx(60 + 240 * 98 / 99) and got[0] == pytest.approx(60 + 240 * 98 / 99)
