import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tallybrook.functions.display import bot_rate, console_line, per_second, share_percent, shown, status_band
from tallybrook.operators import health, series
from tallybrook.schemas import SLICE
from tallybrook.sources.progress import ProgressTable, read_samples, topic_offsets
from tallybrook.settings import DELAY_BANDS, EMIT_DELAY_BOUNDS, LAG_BANDS


def samples(spark, rows, metric="c"):
    """(second, label value, value)"""
    data = [(metric, {"p": p}, float(v), t) for t, p, v in rows]
    df = spark.createDataFrame(data, "metric string, labels map<string,string>, value double, s long")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s")


def test_counter_reset_and_first_sample(spark):
    df = samples(spark, [(0, "a", 100), (30, "a", 130), (60, "a", 5), (90, "a", 9), (30, "b", 7), (60, "b", 8)])
    got = {(r["p"], r["t"]): r["increase"] for r in series.counter_rate(df, 60, ["p"]).collect()}
    assert got == {("a", 0): 30.0, ("a", 60): 9.0, ("b", 60): 1.0}
    total = {r["t"]: r["rate"] for r in series.counter_rate(df, 60).collect()}
    assert total == {0: 0.5, 60: 10 / 60}


def test_counter_over_chunk_edges(spark):
    """The chunk is a day; growth over midnight is kept."""
    df = samples(spark, [(86_390, "a", 10), (86_410, "a", 14), (3 * 86_400, "a", 20)])
    assert sum(r["increase"] for r in series.counter_rate(df, 3600).collect()) == 10


def test_rolling_rate(spark):
    df = samples(spark, [(t, "a", t) for t in range(0, 600, 60)])
    steps = series.counter_rate(df, 60)
    rates = {r["t"]: r["rate"] for r in series.rolling_rate(steps, ["metric"], 300).collect()}
    assert rates[540] == 1.0 and rates[60] == 60 / 300


def test_gauges(spark):
    df = samples(spark, [(0, "a", 5), (30, "a", 2), (10, "b", 4)])
    assert [r["value"] for r in series.gauge_by_label(df, "sum", None, 60).collect()] == [6.0]
    assert [r["value"] for r in series.gauge_by_label(df, "max", None, 60).collect()] == [4.0]
    assert {r["label"]: r["value"] for r in series.gauge_by_label(df, "max", "p", 60).collect()} == {"a": 2.0, "b": 4.0}
    with pytest.raises(ValueError):
        series.gauge_by_label(df, "avg", None, 60)


@pytest.mark.parametrize("values, q, want", [
    ([0.4, 0.4, 1.4, 1.4], 0.5, 0.5), ([0.4, 1.4, 1.4, 1.4], 0.5, 1.0 + 0.5 / 3),
    ([100.0], 0.99, 30.0), ([0.1], 0.5, 0.25), ([], 0.5, None)])
def test_histogram_quantile(spark, values, q, want):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = series.histogram_quantile(series.observe(df, "v", EMIT_DELAY_BOUNDS), q).first()["quantile"]
    assert got is None if want is None else got == pytest.approx(want)


def test_quantile_equals_walking_the_buckets(spark):
    rng = random.Random(9)
    for _ in range(12):
        values = [rng.choice([0.2, 0.7, 1.1, 2.2, 2.5, 4.0, 50.0]) for _ in range(rng.randrange(1, 30))]
        q = rng.choice([0.0, 0.1, 0.5, 0.9, 0.99, 1.0])
        df = spark.createDataFrame([(v,) for v in values], "v double")
        got = series.histogram_quantile(series.observe(df, "v", EMIT_DELAY_BOUNDS), q).first()["quantile"]
        assert got == pytest.approx(walked(values, q))


def walked(values, q):
    low, below, rank = 0.0, 0, q * len(values)
    for bound in (*EMIT_DELAY_BOUNDS, float("inf")):
        held = sum(v <= bound for v in values)
        if held >= rank and held > 0:
            return low if bound == float("inf") or held == below else low + (bound - low) * (rank - below) / (held - below)
        low, below = bound, held


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_bands(spark):
    for value, band in ((0, "green"), (999, "green"), (1000, "yellow"), (3000, "red"), (None, None)):
        assert one(spark, status_band(F.lit(value).cast("double"), LAG_BANDS)) == band
    assert one(spark, status_band(F.lit(2.5), DELAY_BANDS)) == "yellow"


def test_display_figures(spark):
    assert one(spark, per_second(F.lit(117), 5)) == 23.4
    assert one(spark, per_second(F.lit(117), 0)) == 0.0
    assert one(spark, bot_rate(F.lit(10.0), F.lit(1), F.lit(4))) == 2.5
    assert one(spark, bot_rate(F.lit(0.0), F.lit(0), F.lit(0))) == 0.0
    assert one(spark, share_percent(F.lit(1), F.lit(0))) is None


def test_console_line(spark):
    wikis = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(n).alias("count")) for k, n in
                      (("en", 1200), ("de", 30), ("fr", 2), ("es", 1), ("it", 1))])
    line = one(spark, console_line(F.lit(3661), F.lit(1234), F.lit(246.8), wikis, F.lit(1), F.lit(3)))
    assert line == "[01:01:01] 1,234 edits ( 246.8/s) | en: 1,200, de: 30, fr: 2, es: 1 | bots: 25%"
    empty = F.array().cast("array<struct<key:string,count:int>>")
    assert one(spark, console_line(F.lit(0), F.lit(0), F.lit(0.0), empty, F.lit(0), F.lit(0))) == (
        "[00:00:00]     0 edits (   0.0/s) | - | bots: 0%")


def test_cold_path_states(spark):
    at = dt.datetime(2024, 1, 1, 12)
    edits = spark.createDataFrame([(at,)], "ingested_at timestamp_ntz")
    none = spark.createDataFrame([], "error string")
    some = spark.createDataFrame([("bad",)], "error string")

    def state(df, errors, as_of):
        r = health.cold_path_health(df, errors, as_of, grown_since="2024-01-01 11:59:45").first()
        return r["state"], r["healthy"]

    assert state(edits, none, "2024-01-01 12:00:30") == ("ok", True)
    assert state(edits, some, "2024-01-01 12:00:30") == ("ok", False)
    assert state(edits, none, "2024-01-01 12:02:00") == ("stale", False)
    assert state(edits.limit(0), none, "2024-01-01 12:00:30") == ("empty", False)


def test_live_path_states(spark):
    rows = [(100, 105, p, 1, 0.2, [], (0, 1), [], [], None) for p in (0, 3)] + [(95, 100, 1, 1, 0.2, [], (0, 1), [], [], None)]
    slices = spark.createDataFrame(rows, SLICE)
    ok = health.live_path_health(slices, 130).first()
    assert (ok["latest_window"], ok["partitions"], ok["status"]) == (100, 2, "ok")
    assert health.live_path_health(slices, 136).first()["status"] == "no recent window"
    assert health.live_path_health(slices.limit(0), 136).first()["status"] == "no windows"


def test_consumer_lag(spark):
    latest = spark.createDataFrame([(0, 100), (1, 50)], "partition int, end_offset long")
    committed = spark.createDataFrame([(0, 90)], "partition int, committed long")
    got = {r["partition"]: (r["lag"], r["total_lag"]) for r in health.consumer_lag(latest, committed).collect()}
    assert got == {0: (10, 60), 1: (50, 60)}


def test_shown_figures_round_the_exact_value(spark):
    rng = random.Random(21)
    for places in (1, 2):
        values = [n / 60 for n in (0, 3, 9, 15, 45, 60, 1000)] + [0.125, 2.675, 1.005, 0.05, 0.25, 0.35, 1e-9, 8.345, 12345.675]
        values += [rng.randrange(100_000) / rng.choice([60, 1440, 7, 200, 8]) for _ in range(1000)]
        df = spark.createDataFrame([(v,) for v in values], "v double")
        step = Decimal(1).scaleb(-places)
        for r in df.select("v", shown(F.col("v"), places).alias("s")).collect():
            assert r["s"] == float(Decimal(r["v"]).quantize(step, ROUND_HALF_UP)), r


REPORT = {
    "id": "a", "name": "stored", "timestamp": "2024-01-02T03:04:05.000Z", "numInputRows": 70, "durationMs": {"addBatch": 1500},
    "eventTime": {"watermark": "2024-01-02T03:03:00.000Z"}, "stateOperators": [{"numRowsTotal": 9, "numRowsDroppedByWatermark": 2}],
    "observedMetrics": {"payloads": {"accepted": 66, "invalid": 4}},
    "sources": [{"endOffset": '{"edits": {"0": 90, "1": 50}}', "latestOffset": {"edits": {"0": 100, "1": 50}}},
                {"endOffset": {"logOffset": 3}, "latestOffset": None}],
}


def test_a_progress_report_as_samples(spark, tmp_path):
    table = ProgressTable(spark, str(tmp_path))
    table.write(REPORT)
    table.write({**REPORT, "timestamp": "2024-01-02T03:04:15.000Z", "sources": [
        {"endOffset": {"edits": {"0": 95, "1": 50}}, "latestOffset": {"edits": {"0": 120, "1": 53}}}]})
    samples = read_samples(spark, str(tmp_path))
    got = {(r["metric"], *sorted(r["labels"].items())): r["value"] for r in samples.filter("ts < '2024-01-02 03:04:10'").collect()}
    own = ("query", "stored")
    assert got["stream_batch_rows", own] == 70 and got["stream_step_seconds", own, ("step", "addBatch")] == 1.5
    assert got["watermark_lag_seconds", own] == 65 and got["stream_rows_behind_watermark", ("operator", "0"), own] == 2
    assert got["stream_observed", ("field", "invalid"), ("metric", "payloads"), own] == 4
    lag = health.consumer_lag(*topic_offsets(samples)).collect()
    assert sorted((r["topic"], r["partition"], r["lag"], r["total_lag"]) for r in lag) == [("edits", 0, 25, 28), ("edits", 1, 3, 28)]
