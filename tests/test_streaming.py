import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tallybrook.functions.clock import epoch_seconds
from tallybrook.operators import windows
from tallybrook.operators.health import slice_delays
from tallybrook.operators.rollup import rollup_day, rollup_minute, with_estimates
from tallybrook.plans.analytics import freshness, timeline, top_editors
from tallybrook.sources.event_log import load_edits, load_messages
from tallybrook.sources.messages import clean_rows, dead_letters, judged
from tallybrook.sources.topics import kafka_options, read_landed
from tallybrook.schemas import EDITS
from tallybrook.streaming.live import newest_slices, read_slices, start_live_totals, start_live_windows, write_slices
from tallybrook.streaming.stored import StoredTables, start_stored_path

SIZE, GRACE, FILES = 300, 60, 4
EVER = "1970-01-01"
NOW = {"availableNow": True}


def land(df, folder, order, files=FILES):
    """Write a table as files by order of arrival, with rising modification times."""
    bounds = df.agg(F.min(order), F.max(order)).first()
    step = (bounds[1] - bounds[0]) // files + 1
    for i in range(files):
        part = df.filter(F.floor((F.col(order) - bounds[0]) / step) == i)
        part.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.02)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    folder = "/root/testdata/sf0.001"
    base = tmp_path_factory.mktemp("landed")
    messages = load_messages(spark, folder).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    edits = load_edits(spark, folder)
    for c in ("ingested_at", "event_time"):
        edits = edits.withColumn(c, F.col(c).cast("timestamp"))
    land(messages, f"{base}/messages", "offset")
    land(edits.select(*EDITS.names), f"{base}/edits", "kafka_offset")
    return {"messages": f"{base}/messages", "edits": f"{base}/edits"}


def edit_stream(spark, landed):
    return spark.readStream.schema(EDITS).option("maxFilesPerTrigger", 1).parquet(landed["edits"])


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("PartitionFilters: "):plan.index("PushedFilters")]


def test_stored_path_equals_batch_and_survives_restart(spark, landed, tmp_path):
    tables, seen = StoredTables(spark, f"{tmp_path}/tables"), []
    for _ in range(2):
        # The second run finds nothing new on the same checkpoint.
        query = start_stored_path(
            read_landed(spark, landed["messages"], files_per_trigger=1),
            tables.folder, f"{tmp_path}/checkpoint", trigger=NOW,
        )
        query.awaitTermination(300)
        seen.append([p["observedMetrics"]["payloads"] for p in query.recentProgress if p["numInputRows"]])
    parsed = judged(spark.read.parquet(landed["messages"]))
    clean = clean_rows(parsed)
    assert sum(m["accepted"] for m in seen[0]) == clean.count()
    assert sum(m["unparseable"] + m["invalid"] for m in seen[0]) == dead_letters(parsed).count()
    assert rows(tables.edits().select(*clean.columns)) == rows(clean)
    wanted = dead_letters(parsed).drop("seen_at")
    assert rows(tables.errors().select(*wanted.columns)) == rows(wanted)
    assert tables.edits().count() + tables.errors().count() == parsed.count()
    minute, daily = tables.minute().drop("minute_date"), tables.daily().drop("day_date")
    assert rows(with_estimates(minute)) == rows(with_estimates(rollup_minute(clean)))
    assert rows(with_estimates(daily)) == rows(with_estimates(rollup_day(rollup_minute(clean))))
    as_of, whole = "2024-01-31 00:00:00", rollup_minute(clean)
    for bucket, range_, folder in (("1h", "7d", "minute_date"), ("1d", "30d", "day_date")):
        stored = timeline(tables.minute_parts(), tables.day_parts(), range_, bucket, as_of)
        assert rows(stored) == rows(timeline(whole, rollup_day(whole), range_, bucket, as_of))
        assert f"({folder}#" in partition_filters(stored)
    assert "(ingest_date#" in partition_filters(top_editors(tables.edits(), "7d", 5, as_of))
    assert "(ingest_date#" in partition_filters(freshness(tables.edits(), as_of))
    assert tables.day_parts().count() > tables.daily().count()


def test_rerun_batch_changes_nothing(spark, landed, tmp_path):
    from tallybrook.streaming.stored import store_batch

    tables = StoredTables(spark, str(tmp_path))
    batch = judged(spark.read.parquet(landed["messages"])).withColumn("seen_at", F.lit("2024-02-01").cast("timestamp"))
    store_batch(batch, 3, tables)
    first = (tables.edits().count(), rows(with_estimates(tables.minute())), rows(with_estimates(tables.daily())))
    store_batch(batch, 3, tables)
    assert first == (tables.edits().count(), rows(with_estimates(tables.minute())), rows(with_estimates(tables.daily())))


def test_compacted_rollup_has_one_row_per_key(spark, landed, tmp_path):
    from tallybrook.operators.rollup import rollup_read
    from tallybrook.schemas import MINUTE_ROLLUP
    from tallybrook.sources.tables import append_batch, compact_days, read_table

    edits = spark.read.schema(EDITS).parquet(landed["edits"])
    for batch in (0, 1):
        append_batch(rollup_minute(edits), f"{tmp_path}/parts", batch, F.to_date("minute"), date_name="minute_date")
    parts = read_table(spark, f"{tmp_path}/parts", MINUTE_ROLLUP, date_name="minute_date")
    days = [str(r[0]) for r in parts.select("minute_date").distinct().collect()]
    keys = ["minute_date", "minute", "wiki"]
    compact_days(
        spark, f"{tmp_path}/parts", MINUTE_ROLLUP, days, f"{tmp_path}/whole", order=("minute", "wiki"),
        date_name="minute_date", reduce=lambda rows: rollup_read(rows, keys),
    )
    whole = read_table(spark, f"{tmp_path}/whole", MINUTE_ROLLUP, date_name="minute_date")
    assert whole.count() * 2 == parts.count()
    same = rollup_read(parts, keys)
    assert rows(with_estimates(whole.select(*same.columns))) == rows(with_estimates(same))


def test_compaction_is_seen_once(spark, landed, tmp_path):
    """Counts are the same before, while and after days are compacted, and with batches that come later."""
    from tallybrook.sources.tables import append_batch, compact, compacted_days, read_compacted, read_table

    path, edits = f"{tmp_path}/edits", spark.read.schema(EDITS).parquet(landed["edits"])
    day = F.to_date("ingested_at")
    for batch in (0, 1):
        append_batch(edits.filter(F.col("kafka_offset") % 3 == batch), path, batch, day)
    read = lambda: read_compacted(spark, path, EDITS)
    first, want = read(), edits.filter(F.col("kafka_offset") % 3 < 2)
    assert rows(read().select(*want.columns)) == rows(want)
    days = [str(r[0]) for r in edits.select(day).distinct().collect()][:5]
    compact(spark, path, EDITS, days)
    assert compacted_days(spark, path) == {d: 1 for d in days}
    # A reader from before goes on with the batches, a new one takes the compacted days.
    assert first.count() == want.count() and rows(read().select(*want.columns)) == rows(want)
    assert any("_compacted" in f for f in read().inputFiles())
    append_batch(edits.filter(F.col("kafka_offset") % 3 == 2), path, 2, day)
    assert rows(read().select(*edits.columns)) == rows(edits)
    compact(spark, path, EDITS, days[:2])
    assert rows(read().select(*edits.columns)) == rows(edits) and compacted_days(spark, path)[days[0]] == 2
    # A compaction that did not get to its note is not read.
    compacted = read_table(spark, path, EDITS).limit(7)
    append_batch(compacted.drop("ingest_date", "batch_id"), f"{path}_compacted/upto=9", 0, day)
    assert rows(read().select(*edits.columns)) == rows(edits)


def test_compacted_stored_tables(spark, landed, tmp_path):
    """Queries give the same on compacted days, redeliveries are still found, and expired days go whole."""
    from tallybrook.sources.tables import drop_expired
    from tallybrook.streaming.stored import store_batch

    tables, messages = StoredTables(spark, str(tmp_path)), spark.read.parquet(landed["messages"])
    parts = [judged(messages.filter(f"offset % 2 = {k}")).withColumn("seen_at", F.lit("2024-02-01").cast("timestamp")) for k in (0, 1)]
    for n in (0, 1):
        store_batch(parts[n], n, tables, redelivery_days=40)
    as_of = "2024-01-31 00:00:00"

    def answers():
        return (tables.edits().count(), rows(timeline(tables.minute_parts(), tables.day_parts(), "7d", "1h", as_of)),
                rows(with_estimates(tables.daily())), rows(top_editors(tables.edits(), "7d", 5, as_of)))

    before = answers()
    parts_before = tables.day_parts().count()
    days = [str(r[0]) for r in tables.edits().select("ingest_date").distinct().collect()]
    tables.compact(sorted(days)[:20])
    assert answers() == before and tables.day_parts().count() < parts_before
    store_batch(parts[0], 2, tables, redelivery_days=40)
    assert answers() == before
    gone = drop_expired(spark, tables.path("edits"), "edits", as_of)
    left = tables.edits()
    assert gone and sorted(days)[0] in gone and left.count() < before[0]
    assert not {str(r[0]) for r in left.select("ingest_date").distinct().collect()} & set(gone)


def test_exact_editors_merge_over_days(spark):
    """200,000 editors, each on several days and wikis, against a distinct count."""
    from tallybrook.operators.exact_editors import count_editors, editor_bitmaps, number_editors

    edits = spark.range(600_000).select(
        F.concat(F.lit("u"), (F.col("id") * 7919 % 200_003).cast("string")).alias("user"),
        F.concat(F.lit("w"), (F.col("id") % 3).cast("string")).alias("wiki"),
        F.expr("date_add(date'2024-01-01', cast(id % 7 as int))").alias("day")).withColumn(
        "user", F.when(F.col("user") != "u5", F.col("user")))
    nobody = spark.createDataFrame([], "user string, number long")
    numbers = number_editors(edits, nobody, per_chunk=9_000)
    found = numbers.agg(F.count("*"), F.countDistinct("number"), F.min("number"), F.max("number"), F.countDistinct("user")).first()
    assert tuple(found) == (200_002, 200_002, 1, 200_002, 200_002)
    days = editor_bitmaps(edits, numbers, "day", "wiki")
    for keys in ([], ["wiki"], ["day", "wiki"]):
        want = edits.groupBy(*keys).agg(F.countDistinct("user").alias("editors"))
        assert rows(count_editors(days, keys)) == rows(want)


def test_editors_keep_their_numbers(spark):
    from tallybrook.operators.exact_editors import number_editors

    users = lambda *names: spark.createDataFrame([(n,) for n in names], "user string")
    known = spark.createDataFrame([("a", 1), ("b", 7)], "user string, number long")
    fresh = number_editors(users("b", "c", "c", None, "d"), known)
    assert sorted(r["user"] for r in fresh.collect()) == ["c", "d"]
    assert sorted(r["number"] for r in fresh.collect()) == [8, 9] and rows(fresh) == rows(number_editors(users("d", "c"), known))


def test_stored_editors_are_exact_over_batches(spark, landed, tmp_path):
    from tallybrook.operators.exact_editors import count_editors
    from tallybrook.streaming.stored import store_batch

    tables, messages = StoredTables(spark, str(tmp_path)), spark.read.parquet(landed["messages"])
    parts = [judged(messages.filter(f"offset % 3 = {k}")).withColumn("seen_at", F.lit("2024-02-01").cast("timestamp")) for k in range(3)]
    for n in (0, 1, 1, 2):
        store_batch(parts[n], n, tables, exact_editors=True)
    want = clean_rows(judged(messages)).groupBy("wiki").agg(F.countDistinct("user").alias("editors")).filter("editors > 0")
    assert rows(count_editors(tables.day_editors(), ["wiki"])) == rows(want)
    assert tables.editor_numbers().groupBy("user").count().filter("count > 1").count() == 0


def test_new_messages_read_no_stored_file(spark, landed, tmp_path):
    """Only batches whose offsets meet a batch's own are looked up for redeliveries."""
    from tallybrook.streaming.stored import batch_offsets, overlapping_batches, store_batch

    tables, messages = StoredTables(spark, str(tmp_path)), spark.read.parquet(landed["messages"])
    parts = [judged(messages.filter(f)).withColumn("seen_at", F.lit("2024-02-01").cast("timestamp"))
             for f in ("offset < 300", "offset between 300 and 599", "offset between 250 and 320", "offset >= 600")]
    for n in (0, 1):
        store_batch(parts[n], n, tables, redelivery_days=40)
    met = lambda part, n: overlapping_batches(batch_offsets(part), tables, n, dt.date(2024, 1, 31), 40)
    assert met(parts[1], 1) == [] and met(parts[2], 2) == [0, 1] and met(parts[3], 3) == []
    store_batch(parts[2], 2, tables, redelivery_days=40)
    store_batch(parts[3], 3, tables, redelivery_days=40)
    assert tables.edits().count() == clean_rows(judged(messages)).count()


def test_progress_of_a_run_as_samples(spark, landed, tmp_path):
    from tallybrook.operators import rules
    from tallybrook.sources.progress import ProgressTable, read_samples

    listener = ProgressTable(spark, f"{tmp_path}/samples")
    spark.streams.addListener(listener)
    try:
        start_stored_path(read_landed(spark, landed["messages"], files_per_trigger=1), f"{tmp_path}/tables", trigger=NOW).awaitTermination(300)
        start_live_windows(edit_stream(spark, landed), f"{tmp_path}/slices", source="arrival", size=SIZE, grace=GRACE,
                           trigger=NOW).awaitTermination(300)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(listener)
    samples = read_samples(spark, f"{tmp_path}/samples")
    total = lambda metric, **labels: sum(r["value"] for r in samples.filter(F.col("metric") == metric).collect()
                                         if all(r["labels"].get(k) == v for k, v in labels.items()))
    messages = spark.read.parquet(landed["messages"])
    read = messages.count() + spark.read.parquet(landed["edits"]).count()
    assert total("stream_batch_rows") == read
    assert total("stream_observed", field="accepted") == clean_rows(judged(messages)).count()
    assert samples.filter("metric = 'watermark_lag_seconds' and value > 0").count() > 0
    # Rules read them like any others.
    now = int(time.time())
    lag = rules.Rule("Behind", rules.Expression("watermark_lag_seconds", window=3600, total="max"), ">", 60, 0, "warning")
    states = {r["state"] for r in rules.alert_states(samples, [lag], now, now + 60, 60).collect()}
    assert states == {"firing"}


def test_redeliveries_are_dropped(spark, landed, tmp_path):
    source = f"{tmp_path}/source"
    messages = spark.read.parquet(landed["messages"])
    messages.coalesce(1).write.parquet(source)
    time.sleep(0.02)
    messages.coalesce(1).write.mode("append").parquet(source)
    tables = StoredTables(spark, f"{tmp_path}/tables")
    start_stored_path(
        read_landed(spark, source, files_per_trigger=1), tables.folder, f"{tmp_path}/checkpoint",
        redelivery_days=40, trigger=NOW,
    ).awaitTermination(300)
    assert tables.edits().count() == clean_rows(judged(messages)).count()


def test_live_windows_equal_batch_slices(spark, landed, tmp_path):
    query = start_live_windows(
        edit_stream(spark, landed), f"{tmp_path}/slices", f"{tmp_path}/checkpoint",
        source="arrival", size=SIZE, grace=GRACE, trigger=NOW,
    )
    query.awaitTermination(300)
    edits = spark.read.schema(EDITS).parquet(landed["edits"])
    mark = edits.agg(F.max(epoch_seconds(F.col("ingested_at")))).first()[0]
    batch = windows.window_slices(edits, F.col("ingested_at"), SIZE).filter(
        F.col("window_end") + GRACE <= mark
    )
    got = read_slices(spark, f"{tmp_path}/slices", EVER)
    assert rows(got.filter("total_edits > 0").select(*batch.columns)) == rows(batch)
    # Written long after the data's own time, and dropped once that is further back than a lifetime.
    assert slice_delays(got).filter("delay_seconds > 0").count() == got.count()
    now = int(time.time())
    written = F.unix_seconds("written_at")
    assert windows.within_ttl(got, written, now, 3600).count() == got.count()
    assert windows.within_ttl(got, written, now + 7200, 3600).count() == 0
    recent = read_slices(spark, f"{tmp_path}/slices", since="2024-01-20")
    assert 0 < recent.count() < got.count() and "(window_date#" in partition_filters(recent)


def starts_of(slices):
    out = {}
    for r in slices.select("partition", "window_start").collect():
        out.setdefault(r[0], []).append(r[1])
    return {p: sorted(own) for p, own in out.items()}


def test_restart_on_a_checkpoint_equals_one_run(spark, landed, tmp_path):
    part = f"{tmp_path}/part"
    edits = spark.read.schema(EDITS).parquet(landed["edits"])
    stream = lambda: spark.readStream.schema(EDITS).option("maxFilesPerTrigger", 1).parquet(part)
    for half in ("kafka_offset < 500", "kafka_offset >= 500"):
        edits.filter(half).coalesce(1).write.mode("append").parquet(part)
        start_live_windows(
            stream(), f"{tmp_path}/stopped", f"{tmp_path}/cp1", source="arrival", size=SIZE,
            grace=GRACE, trigger=NOW,
        ).awaitTermination(300)
    start_live_windows(
        stream(), f"{tmp_path}/whole", f"{tmp_path}/cp2", source="arrival", size=SIZE,
        grace=GRACE, trigger=NOW,
    ).awaitTermination(300)
    stopped, whole = (read_slices(spark, f"{tmp_path}/{n}", EVER).drop("written_at") for n in ("stopped", "whole"))
    assert rows(stopped) == rows(whole)
    # No gaps, also over the restart and in partitions that had gone quiet by then.
    for own in starts_of(stopped).values():
        assert own == list(range(own[0], own[-1] + 1, SIZE))
    assert len({own[-1] for own in starts_of(stopped).values()}) == 1
    assert stopped.filter("total_edits = 0 and size(edits_per_wiki) = 0 and bot_vs_human.human = 0").count() == stopped.filter(
        "total_edits = 0").count() > 0


def test_newest_slices_read_the_newest_days(spark, landed, tmp_path):
    edits = spark.read.schema(EDITS).parquet(landed["edits"])
    slices = windows.window_slices(edits, F.col("ingested_at"), SIZE)
    write_slices(slices, str(tmp_path), 0)
    starts = sorted(r[0] for r in slices.select("window_start").distinct().collect())
    for n in (1, 40, len(starts), len(starts) + 10):
        newest = newest_slices(spark, str(tmp_path), n)
        assert sorted(r[0] for r in newest.select("window_start").distinct().collect()) == starts[-n:]
        assert rows(newest.select(*slices.columns)) == rows(slices.filter(F.col("window_start") >= starts[-n:][0]))
    few = newest_slices(spark, str(tmp_path), 5)
    assert "(window_date#" in partition_filters(few)
    assert newest_slices(spark, f"{tmp_path}/none", 5).count() == 0


def test_live_totals_write_revisions(spark, landed, tmp_path):
    start_live_totals(
        edit_stream(spark, landed), f"{tmp_path}/totals", f"{tmp_path}/checkpoint",
        source="event", size=3600, grace=86_400, trigger=NOW,
    ).awaitTermination(300)
    versions = spark.read.parquet(f"{tmp_path}/totals").withColumnRenamed("batch_id", "version")
    last = windows.latest_version(versions.select("window_start", "version", "total"), ["window_start"])
    edits = spark.read.schema(EDITS).parquet(landed["edits"])
    whole = edits.groupBy((epoch_seconds(F.col("event_time")) / 3600).cast("long")).count()
    assert sorted(r["total"] for r in last.collect()) == sorted(r["count"] for r in whole.collect())
    changes = windows.window_changes(versions.select("window_start", "version", "total"))
    assert changes.count() >= last.count()


def test_a_clock_far_ahead_counts_where_it_says(spark, tmp_path):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(at + dt.timedelta(seconds=n), at + dt.timedelta(seconds=n + ahead), "w", "edit", None, "u", n, False, 0, n)
            for n, ahead in enumerate((0, 0, 300, 0))]
    spark.createDataFrame(rows, EDITS).coalesce(1).write.parquet(f"{tmp_path}/in")
    start_live_totals(
        spark.readStream.schema(EDITS).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", source="event", size=60,
        grace=3600, trigger=NOW,
    ).awaitTermination(300)
    got = {r["window_start"] - int(at.timestamp()): r["total"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {0: 3, 300: 1}


def test_checkpoints_are_bound_to_their_target(spark, landed, tmp_path):
    """Two targets of one source both get all rows; a lost checkpoint is no licence to overwrite."""
    import shutil

    clean = clean_rows(judged(spark.read.parquet(landed["messages"]))).count()
    folders = [f"{tmp_path}/{name}" for name in ("one", "two")]
    for folder in folders:
        start_stored_path(read_landed(spark, landed["messages"]), folder, trigger=NOW).awaitTermination(300)
        assert StoredTables(spark, folder).edits().count() == clean
    shutil.rmtree(f"{folders[0]}/_checkpoint")
    with pytest.raises(ValueError, match="first_batch=1"):
        start_stored_path(read_landed(spark, landed["messages"]), folders[0], trigger=NOW)
    start_stored_path(
        read_landed(spark, landed["messages"]), folders[0], first_batch=1, redelivery_days=40, trigger=NOW,
    ).awaitTermination(300)
    assert StoredTables(spark, folders[0]).edits().count() == clean


def test_late_first_deliveries_are_kept(spark, tmp_path):
    from tallybrook.streaming.stored import store_batch

    tables = StoredTables(spark, str(tmp_path))

    def batch(n, *messages):
        texts = [("t", 0, offset, dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc), '{"type":"edit","wiki":"w"}')
                 for offset, day in messages]
        df = spark.createDataFrame(texts, "topic string, partition int, offset long, timestamp timestamp, value string")
        store_batch(judged(df).withColumn("seen_at", F.current_timestamp()), n, tables, redelivery_days=2)

    batch(0, (1, 20), (2, 20))
    batch(1, (2, 21), (3, 21), (3, 21), (4, 2))
    assert sorted(r["kafka_offset"] for r in tables.edits().collect()) == [1, 2, 3, 4]


def test_checkpoints_go_to_the_shared_folder(spark):
    from tallybrook.session import shared_folder

    assert shared_folder(spark, "x") == spark.conf.get("spark.checkpoint.dir") + "/x"


def test_topic_options():
    live = kafka_options("broker:9092", per_trigger=2000)
    assert live["startingOffsets"] == "latest" and live["maxOffsetsPerTrigger"] == "2000"
    assert kafka_options("broker:9092", starting="earliest")["startingOffsets"] == "earliest"
