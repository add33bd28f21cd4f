"""The stored path: raw edits, dead letters and chained rollups, one batch at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybrook.operators.exact_editors import editor_bitmaps, number_editors
from tallybrook.operators.rollup import rollup_day, rollup_minute, rollup_read
from tallybrook.schemas import BATCHES, DAY_EDITORS, DAY_ROLLUP, DEAD_LETTERS, EDITOR_NUMBERS, EDITS, MINUTE_ROLLUP
from tallybrook.sources.messages import clean_rows, dead_letters, judged, observe_drops
from tallybrook.sources.tables import (
    BATCH, RAW_ORDER, append_batch, bound_checkpoint, compact, dedup, read_compacted, read_table, stored_days,
)


# Schema, date folder and order of the tables that can be compacted.
LAYOUT = {
    "edits": (EDITS, "ingest_date", RAW_ORDER),
    "edits_errors": (DEAD_LETTERS, "seen_date", ("seen_at",)),
    "edits_1m": (MINUTE_ROLLUP, "minute_date", ("minute", "wiki")),
    "edits_1d": (DAY_ROLLUP, "day_date", ("day", "wiki")),
}
ROLLUP_KEYS = ("minute", "day", "wiki")
TABLES = ("edits", "edits_errors", "edits_1m", "edits_1d", "batches", "editor_numbers", "editors_1d")


class StoredTables:
    """
    The tables under one folder, with compacted days in place of their batches, and an index of what each batch holds of each partition. The range queries merge partial rollup rows anyway
    and take ``minute_parts`` and ``day_parts`` as they are.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def _read(self, table: str) -> DataFrame:
        schema, date_name, _ = LAYOUT[table]
        return read_compacted(self.spark, self.path(table), schema, date_name=date_name)

    def edits(self) -> DataFrame:
        return self._read("edits")

    def errors(self) -> DataFrame:
        return self._read("edits_errors")

    def minute_parts(self) -> DataFrame:
        return self._read("edits_1m")

    def day_parts(self) -> DataFrame:
        return self._read("edits_1d")

    def compact(self, days: Sequence[str], tables: Sequence[str] = ("edits", "edits_1m", "edits_1d")) -> None:
        """
        Rewrite days as few sorted files, rollups as one row per key. Readers take the batches of a day until
        all of it is written and the compacted day, with batches that come later, from then on.
        """
        for table in tables:
            schema, date_name, order = LAYOUT[table]
            keys = [date_name, *(c for c in order if c in ROLLUP_KEYS)]
            reduce = (lambda rows, keys=keys: rollup_read(rows, keys)) if table in ("edits_1m", "edits_1d") else None
            compact(self.spark, self.path(table), schema, days, order=order, date_name=date_name, reduce=reduce)

    def batches(self) -> DataFrame:
        """Per batch and partition: lowest and highest offset, messages, and the newest arrival."""
        return read_table(self.spark, self.path("batches"), BATCHES, date_name="last_date")

    def editor_numbers(self) -> DataFrame:
        """The number of every editor seen, by the batch that brought it; empty where none are kept."""
        if not stored_days(self.spark, self.path("editor_numbers"), "first_date"):
            return self.spark.createDataFrame([], f"user string, number long, {BATCH} long")
        return read_table(self.spark, self.path("editor_numbers"), EDITOR_NUMBERS, date_name="first_date")

    def day_editors(self) -> DataFrame:
        """Bitmaps of the editors per day, wiki and batch, for exact counts over any days."""
        return read_table(self.spark, self.path("editors_1d"), DAY_EDITORS, date_name="day_date")

    def minute(self) -> DataFrame:
        """One row per minute and wiki; the date folder stays a column, for pruning."""
        return rollup_read(self.minute_parts(), ["minute_date", "minute", "wiki"])

    def daily(self) -> DataFrame:
        return rollup_read(self.day_parts(), ["day_date", "day", "wiki"])


def prepare_stream(messages: DataFrame) -> DataFrame:
    """
    Judge the payloads inside the stream, where "now" is the batch's own recorded time
    and stays the same when the batch is run again.
    """
    rows = messages.withColumn("timestamp", F.coalesce("timestamp", F.current_timestamp()))
    return judged(rows).withColumn("seen_at", F.current_timestamp())


def batch_offsets(messages: DataFrame) -> DataFrame:
    """The index rows of a batch: one per topic partition."""
    return messages.groupBy(F.col("partition").alias("kafka_partition")).agg(
        F.min("offset").alias("low"), F.max("offset").alias("high"), F.count("*").alias("messages"),
        F.max("timestamp").alias("newest"))


def overlapping_batches(own: DataFrame, tables: StoredTables, batch_id: int, oldest, days: int) -> list[int]:
    """
    The earlier batches that may hold messages of a batch with the offsets ``own``: those whose range of
    offsets meets its own on a partition. Reads the index only, of the days from ``days`` before ``oldest`` on.
    """
    if batch_id == 0 or not stored_days(tables.spark, tables.path("batches"), "last_date"):
        return []
    earlier = tables.batches().filter((F.col("last_date") >= F.date_sub(F.lit(oldest), days)) & (F.col(BATCH) < batch_id))
    # A row per topic partition, a number the topic fixes.
    mine = F.broadcast(own.select(F.col("kafka_partition").alias("of"), F.col("low").alias("from"), F.col("high").alias("upto")))
    meets = (F.col("kafka_partition") == F.col("of")) & (F.col("low") <= F.col("upto")) & (F.col("high") >= F.col("from"))
    return sorted(r[0] for r in earlier.join(mine, meets).select(BATCH).distinct().collect())


def first_deliveries(edits: DataFrame, offsets: DataFrame, tables: StoredTables, batch_id: int, days: int) -> DataFrame:
    """
    The edits of a batch that neither the batch nor the batches before it hold already.

    Stored messages are looked up by their coordinates in those batches only whose ranges of offsets
    meet the batch's own, none for a batch of new messages. An edit is never dropped for being late.
    """
    oldest = edits.agg(F.min(F.to_date("ingested_at"))).first()[0]
    fresh = dedup(edits)
    before = [] if oldest is None else overlapping_batches(offsets, tables, batch_id, oldest, days)
    if not before:
        return fresh
    # By the batches themselves: a compacted day does not tell them apart.
    held = read_table(tables.spark, tables.path("edits"), EDITS)
    stored = held.filter((F.col("ingest_date") >= F.date_sub(F.lit(oldest), days)) & F.col(BATCH).isin(before))
    return fresh.join(stored.select("kafka_partition", "kafka_offset"), ["kafka_partition", "kafka_offset"],
                      "left_anti").select(*edits.columns)


def store_editors(edits: DataFrame, batch_id: int, tables: StoredTables) -> None:
    """
    Number the editors that a batch brings and write its bitmaps per day and wiki. Numbers follow those of the
    batches before it, so a batch that is run again gives the same ones.
    """
    first = edits.agg(F.min(F.to_date("ingested_at"))).first()[0]
    if first is None:
        return
    # Numbering reads them three times.
    users = edits.select("user").filter("user is not null").distinct().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fresh = number_editors(users, tables.editor_numbers().filter(F.col(BATCH) < batch_id))
        append_batch(fresh, tables.path("editor_numbers"), batch_id, F.lit(first), date_name="first_date", order=("user",))
    finally:
        users.unpersist()
    numbers = tables.editor_numbers().filter(F.col(BATCH) <= batch_id).select("user", "number")
    bitmaps = editor_bitmaps(edits, numbers, F.to_date("ingested_at").alias("day"), "wiki")
    append_batch(bitmaps, tables.path("editors_1d"), batch_id, F.col("day"), date_name="day_date", order=("day", "wiki", "bucket"))


def store_batch(
    batch: DataFrame, batch_id: int, tables: StoredTables, redelivery_days: int | None = None, exact_editors: bool = False
) -> None:
    """
    Write one judged batch to all tables. Each write replaces what the same batch
    wrote before, so a batch that is run again after a crash leaves the tables as they
    were. The day rollup is chained off the batch's own minute rows; only the search for
    redeliveries and, with ``exact_editors``, the numbers of editors read a table.
    """
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    edits, offsets = clean_rows(batch), batch_offsets(batch)
    if redelivery_days is not None:
        edits = first_deliveries(edits, offsets, tables, batch_id, redelivery_days)
    minute = rollup_minute(edits).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        append_batch(offsets, tables.path("batches"), batch_id, F.to_date("newest"), date_name="last_date")
        append_batch(edits, tables.path("edits"), batch_id, F.to_date("ingested_at"), order=RAW_ORDER)
        append_batch(
            dead_letters(batch, F.col("seen_at")), tables.path("edits_errors"), batch_id,
            F.to_date("seen_at"), date_name="seen_date", order=("seen_at",),
        )
        append_batch(
            minute, tables.path("edits_1m"), batch_id,
            F.to_date("minute"), date_name="minute_date", order=("minute", "wiki"),
        )
        append_batch(
            rollup_day(minute), tables.path("edits_1d"), batch_id, F.col("day"),
            date_name="day_date", order=("day", "wiki"),
        )
        if exact_editors:
            store_editors(edits, batch_id, tables)
    finally:
        minute.unpersist()
        batch.unpersist()


def start_stored_path(
    messages: DataFrame, folder: str, checkpoint: str | None = None, *,
    redelivery_days: int | None = None, trigger: dict | None = None, first_batch: int = 0, exact_editors: bool = False,
) -> StreamingQuery:
    """
    Run the stored path over an envelope stream. A new checkpoint counts batches from
    zero again, so it needs a ``first_batch`` beyond those already in the tables, and is
    refused without. The query's progress reports what was refused, by reason, under
    ``payloads``. With ``redelivery_days``, messages stored within so many days are not
    stored again; a checkpointed topic reader does not redeliver, so this is for sources
    that do. With ``exact_editors``, editors are numbered and kept as bitmaps per day as well.
    """
    tables = StoredTables(messages.sparkSession, folder)
    path = bound_checkpoint(messages.sparkSession, folder, checkpoint, first_batch, TABLES)
    return (
        observe_drops(prepare_stream(messages))
        .writeStream.foreachBatch(lambda batch, n: store_batch(batch, first_batch + n, tables, redelivery_days, exact_editors))
        .option("checkpointLocation", path)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
