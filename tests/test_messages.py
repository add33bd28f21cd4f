import json

import pytest
from pyspark.sql import functions as F

from tallybrook.schemas import ENVELOPE
from tallybrook.sources import messages as wire
from tallybrook.sources.tables import (
    append_batch, compact_days, dedup, drop_expired, expired_days, read_table,
)
from tallybrook.sources.topics import publish_files
from tallybrook.schemas import EDITS

VALID = {"id": 12345678, "type": "edit", "title": "Python (programming language)", "wiki": "enwiki",
         "user": "SomeEditor", "timestamp": 1718700000, "bot": False, "comment": "x", "server_url": "y"}


def verdict(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    return wire.judge(df).orderBy("i").select("verdict", "event").collect()


def event(spark, **changes):
    (row,) = verdict(spark, json.dumps({**VALID, **changes}))
    assert row["verdict"] == "ok"
    return row["event"].asDict()


def test_projects_the_seven_fields(spark):
    assert event(spark) == {"id": 12345678, "type": "edit", "title": "Python (programming language)",
                            "wiki": "enwiki", "user": "SomeEditor", "timestamp": 1718700000, "bot": False}
    assert event(spark, id=None, type="log")["id"] is None


def test_refusals(spark):
    without = [{k: v for k, v in VALID.items() if k != f} for f in ("type", "wiki")]
    bad = without + [{**VALID, f: v} for f in ("type", "wiki") for v in (None, "", [], {})]
    bad += [{**VALID, "wiki": v} for v in (7, True)]
    bad += [None, [], "edit", 42, [VALID]]
    assert {r["verdict"] for r in verdict(spark, *map(json.dumps, bad))} == {"invalid"}
    broken = ["{bad", '{"type":"edit","wiki":"x"', json.dumps(VALID) + " zzz", json.dumps(VALID) * 2,
              json.dumps(VALID) + "," + json.dumps(VALID), "{'type':'edit','wiki':'x'}"]
    assert [r["verdict"] for r in verdict(spark, *broken)] == ["unparseable"] * len(broken)
    assert {r["verdict"] for r in verdict(spark, "", "  ", "\n\t", None)} == {"blank"}


@pytest.mark.parametrize("bot, want", [
    (1, True), (0, False), (None, False), ("", False), ("false", True), (True, True), ([], False),
    ([0], True), ({}, False), ({"a": 1}, True), (0.0, False), (0.5, True), (-1, True)])
def test_bot_by_truthiness(spark, bot, want):
    assert event(spark, bot=bot)["bot"] is want


@pytest.mark.parametrize("name", ["7wiki", "true", "-", "[x]", "3", "NaN", "zh-min-nanwiki"])
def test_any_text_is_a_name(spark, name):
    got = event(spark, wiki=name, type=name)
    assert (got["wiki"], got["type"]) == (name, name)


def test_odd_types_of_optional_fields(spark):
    got = event(spark, id="x", title=5, user={"a": 1}, timestamp=True)
    assert (got["id"], got["title"], got["user"], got["timestamp"]) == (None, "5", '{"a":1}', 1)
    assert event(spark, timestamp=float("nan"))["timestamp"] is None


def test_missing_bot_is_human(spark):
    (row,) = verdict(spark, '{"type":"log","wiki":"dewiki"}')
    assert row["event"].asDict() == {"id": None, "type": "log", "title": None, "wiki": "dewiki",
                                     "user": None, "timestamp": None, "bot": False}


@pytest.mark.parametrize("timestamp, want", [
    (None, None), ("2024-06-18", None), ("5", None), (5, 5), (5.5, 5), (-1.5, -2), (0, 0), ([], None), (1e3, 1000)])
def test_clock(spark, timestamp, want):
    assert event(spark, timestamp=timestamp)["timestamp"] == want


def test_last_of_repeated_keys_counts(spark):
    (row,) = verdict(spark, '{"type":"a","wiki":"x","type":"b"}')
    assert row["event"]["type"] == "b"


def test_round_trip_of_published_messages(spark):
    texts = [json.dumps({**VALID, "wiki": w, "user": u}) for w in ("enwiki", "zh-min-nanwiki") for u in ("é", None)]
    sent = wire.keyed(wire.project(spark.createDataFrame([(t,) for t in texts], "value string")))
    rows = sent.collect()
    assert json.loads(rows[0]["value"]) == {k: VALID[k] for k in (
        "id", "type", "title", "wiki", "timestamp", "bot")} | {"user": "é"}
    assert " " not in rows[0]["value"].replace("Python (programming language)", "")
    back = wire.judged(sent.select("value"))
    assert back.filter("error = ''").count() == 4 and back.filter("event.user is null").count() == 2


def envelope(spark, *texts):
    return spark.createDataFrame([("t", 0, i, None, t) for i, t in enumerate(texts)], ENVELOPE)


def test_every_message_lands_in_exactly_one_place(spark):
    parsed = wire.judged(envelope(
        spark, '{"type":"edit","wiki":"x","bot":false}', '{"type":"edit","wiki":"x","bot":1}', "[]", "{bad",
        '{"type":"edit"}', '{"type":"edit","wiki":"x","timestamp":5.5}', None))
    clean, dead = wire.clean_rows(parsed), wire.dead_letters(parsed)
    assert sorted(r["kafka_offset"] for r in clean.collect()) == [0, 1, 5]
    # A payload that is null is blank and nowhere.
    assert sorted(r["kafka_offset"] for r in dead.collect()) == [2, 3, 4]
    assert all(r["ingested_at"] is not None for r in clean.collect())


def test_files_keep_a_wiki_on_one_partition(spark, tmp_path):
    texts = [json.dumps({**VALID, "wiki": f"w{i % 7}", "id": i}) for i in range(70)]
    sent = wire.keyed(wire.project(spark.createDataFrame([(t,) for t in texts], "value string")))
    publish_files(sent, str(tmp_path))
    per_key = spark.read.parquet(str(tmp_path)).groupBy("key").agg(F.count_distinct("partition").alias("n"))
    assert per_key.count() == 7 and per_key.filter("n != 1").count() == 0


def test_tables_retention_and_compaction(spark, tmp_path, data):
    from tallybrook.sources.event_log import load_edits

    edits = load_edits(spark, "/root/testdata/sf0.001").select(
        *[F.col(f.name).cast(f.dataType) for f in EDITS.fields])
    path = f"{tmp_path}/edits"
    for batch in (0, 1, 1):
        append_batch(edits, path, batch, F.to_date("ingested_at"), order=("wiki", "ingested_at"))
    table = read_table(spark, path, EDITS)
    assert table.count() == 2 * edits.count()
    one_day = table.filter("ingest_date = DATE'2024-01-05'")
    assert "PartitionFilters: [isnotnull(ingest_date" in one_day._jdf.queryExecution().executedPlan().toString()
    compact_days(spark, path, EDITS, ["2024-01-05", "2024-01-06"], f"{tmp_path}/compact", files=4)
    compacted = read_table(spark, f"{tmp_path}/compact", EDITS)
    assert compacted.count() == table.filter("ingest_date in (DATE'2024-01-05', DATE'2024-01-06')").count()
    compact_days(spark, path, EDITS, ["2024-01-05"], f"{tmp_path}/unique", reduce=dedup)
    assert read_table(spark, f"{tmp_path}/unique", EDITS).count() * 2 == one_day.count()
    gone = expired_days(spark, path, "edits", "2024-01-20 00:00:00")
    assert gone[0] == "2024-01-01" and gone[-1] == "2024-01-12"
    assert drop_expired(spark, path, "edits", "2024-01-20 00:00:00") == gone
    left = read_table(spark, path, EDITS).agg(F.min("ingest_date")).first()[0]
    assert left.isoformat() == "2024-01-13"
    assert expired_days(spark, path, "edits_1d", "2030-01-01") == []


def test_scalar_types_are_kept_as_text(spark):
    rows = verdict(spark, '{"type":7,"wiki":"a"}', '{"type":true,"wiki":"a"}', '{"type":"","wiki":"a"}',
                   '{"type":[1],"wiki":"a"}', '{"type":null,"wiki":"a"}', '{"type":"x","wiki":7}')
    assert [r["event"] and r["event"]["type"] for r in rows] == ["7", "true", None, None, None, None]


def test_messages_of_one_row_group_are_dealt_over_tasks(spark, tmp_path):
    """A scan reads a row group in one task; building and judging payloads is not left to that task."""
    from tallybrook.sources.event_log import load_messages

    events = spark.range(0, 120_000, 1, 1).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-10 00:00:00' as ts", "id % 50 as user_id", "'click' as event_type",
        "1.0D as value", "concat('{\"k\": ', id % 100, '}') as props")
    events.write.parquet(f"{tmp_path}/events.parquet")
    messages = load_messages(spark, str(tmp_path))
    sizes = [r["count"] for r in messages.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 3 and max(sizes) < 60_000 and sum(sizes) == messages.select("offset").distinct().count() == 120_000
