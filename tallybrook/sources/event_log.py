"""The driver's ``events`` table seen as change events, and inputs derived from it."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.session import prepare
from tallybrook.settings import TOPIC


def load_events(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/events.parquet")


def dealt(rows: DataFrame, keys: tuple[str, ...], least: int = 50_000, most: int = 1_000_000) -> DataFrame:
    """
    The rows dealt over all cores, ``least`` to ``most`` to a task. A scan has no more tasks than the file has row
    groups, and one may hold the whole table; what is dear per row should not begin in so few tasks.
    """
    # From the files' footers.
    count = rows.count()
    tasks = max(min(ceil(count / least), 2 * rows.sparkSession.sparkContext.defaultParallelism), ceil(count / most))
    return rows.repartition(tasks, *keys) if tasks > 1 else rows


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _wiki(k: Column) -> Column:
    return F.concat(F.lit("w"), F.lpad((k % 20).cast("string"), 2, "0"))


def load_edits(spark: SparkSession, folder: str) -> DataFrame:
    """One edit per event; timestamps stay TIMESTAMP_NTZ so that filters reach the scan."""
    k = _k()
    return load_events(spark, folder).select(
        F.col("ts").alias("ingested_at"),
        (F.col("ts") - F.make_dt_interval(mins=(F.col("event_id") * 7919) % 13)).alias("event_time"),
        _wiki(k).alias("wiki"),
        F.when(F.col("event_type") == "signup", "new").otherwise(F.col("event_type")).alias("type"),
        F.lit(None).cast("string").alias("title"),
        F.when(F.col("user_id") % 10 != 0, F.concat(F.lit("u"), F.col("user_id"))).alias("user"),
        F.col("event_id").alias("id"),
        (F.col("user_id") % 3 == 0).alias("bot"),
        ((k % 20) % 6).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
    )


def redelivered(edits: DataFrame) -> DataFrame:
    """The same edits with every error event delivered twice, one second apart."""
    copies = F.when(F.col("type") == "error", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        edits.withColumn("_copy", F.explode(copies))
        .withColumn("ingested_at", F.col("ingested_at") + F.make_dt_interval(secs=F.col("_copy")))
        .drop("_copy")
    )


def load_messages(spark: SparkSession, folder: str) -> DataFrame:
    """
    One upstream payload per event, as an envelope. The counter in ``props`` decides
    the payload's form, so that every way of being malformed occurs all over the table.
    """
    k = F.col("k")

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    def unless(forms: dict[int, Column], usual: Column) -> Column:
        value = usual
        for at, form in forms.items():
            value = F.when(k == at, form).otherwise(value)
        return value

    rows = dealt(load_events(spark, folder), ("event_id", "ts", "user_id")).withColumn("k", _k())
    clock = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    kind = F.when(F.col("event_type") == "signup", "new").otherwise(F.col("event_type"))
    user = F.when(F.col("user_id") % 10 != 0, quoted(F.concat(F.lit("u"), F.col("user_id"))))
    members = {
        "id": unless({12: F.lit("null")}, F.col("event_id").cast("string")),
        "type": unless({4: F.lit("null"), 12: F.lit('"log"'), 14: F.lit("7"), 15: F.lit("true")}, quoted(kind)),
        "title": F.lit("null"),
        "wiki": unless({3: F.lit('""'), 5: F.lit("7")}, quoted(_wiki(k))),
        "user": F.coalesce(user, F.lit("null")),
        "timestamp": unless({6: F.concat(clock, F.lit(".5")), 7: F.lit('"2024-06-18"')}, clock),
        "bot": unless(
            {8: F.lit('"false"'), 9: F.lit("0"), 10: F.lit("1"), 11: F.lit("null")},
            (F.col("user_id") % 3 == 0).cast("string"),
        ),
        "comment": F.lit('"dropped"'),
    }
    pairs = [F.concat(F.lit(f'"{name}":'), text) for name, text in members.items()]
    whole = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    broken = {0: F.lit("{bad"), 1: F.lit("[]"), 2: F.lit("   "), 13: F.lit("42")}
    return rows.select(
        F.lit(TOPIC).alias("topic"),
        ((k % 20) % 6).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        unless(broken, whole).alias("value"),
    )
