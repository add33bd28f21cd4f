"""
Parquet tables written batch by batch.

Every write belongs to a numbered batch and lands in that batch's own partition
folder. A batch that is run again replaces what it wrote before, so a replay after
a crash changes nothing. Date partitions sit above the batch folders, for pruning
and for dropping whole days.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.functions.clock import AsOf, as_of_column
from tallybrook.settings import RETENTION_DAYS

RAW_ORDER = ("wiki", "ingested_at", "kafka_partition", "kafka_offset")
BATCH = "batch_id"
COMPACTED = "_compacted"


def append_batch(
    df: DataFrame, path: str, batch_id: int, date: Column, *, date_name: str = "ingest_date",
    order: Sequence[str] = (),
) -> None:
    """
    Write one batch; running the same batch again overwrites only its own folders.

    Rows are sorted inside each file (row groups then carry tight min/max values for
    the leading key) but not shuffled: a hot wiki or day stays spread over the tasks
    that read it.
    """
    rows = df.withColumn(date_name, date).withColumn(BATCH, F.lit(int(batch_id)).cast("long"))
    rows = rows.sortWithinPartitions(date_name, *order)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_name, BATCH)
        .parquet(path)
    )


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, *, date_name: str = "ingest_date"
) -> DataFrame:
    """Read a batch table with its declared schema plus the two partition columns."""
    full = (
        T.StructType(list(schema.fields)).add(date_name, T.DateType()).add(BATCH, T.LongType())
    )
    return spark.read.schema(full).parquet(path)


def bound_checkpoint(
    spark: SparkSession, folder: str, checkpoint: str | None, first_batch: int, tables: Sequence[str] = ("",)
) -> str:
    """
    The checkpoint of a query that writes to ``folder``: ``checkpoint``, or one inside the folder.

    A new checkpoint counts batches from ``first_batch`` again. Where the folder holds batches
    from there on, they would be overwritten, so that is refused.
    """
    path = checkpoint or f"{folder}/_checkpoint"
    if not _names(spark, f"{path}/offsets"):
        for table in tables:
            numbers = stored_batches(spark, f"{folder}/{table}")
            if max(numbers, default=-1) >= first_batch:
                raise ValueError(
                    f"{folder} holds batches up to {max(numbers)} that checkpoint {path} does not know; "
                    f"give first_batch={max(numbers) + 1} to add to them")
    return path


def compact_days(
    spark: SparkSession, path: str, schema: T.StructType, days: Sequence[str], target: str, *,
    order: Sequence[str] = RAW_ORDER, date_name: str = "ingest_date", files: int | None = None,
    reduce: Callable[[DataFrame], DataFrame] | None = None, upto: int | None = None,
) -> None:
    """
    Rewrite days of a table, or their batches up to ``upto``, into ``target`` as range-sorted files, all in
    batch 0. ``reduce`` merges the batches' rows first: partial rollup rows into one per key, or
    versions into the newest; it keeps the date column.

    The range partitioning is on the whole sort key, whose trailing columns are unique,
    so a wiki holding a third of a day is cut into several files like any other data.
    """
    table = read_table(spark, path, schema, date_name=date_name)
    rows = table.filter(F.col(date_name).isin(*[F.lit(d).cast("date") for d in days]))
    if upto is not None:
        rows = rows.filter(F.col(BATCH) <= upto)
    rows = (reduce(rows) if reduce else rows).drop(BATCH)
    keys = [F.col(date_name), *[F.col(c) for c in order]]
    ranged = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    append_batch(ranged, target, 0, F.col(date_name), date_name=date_name, order=order)


def compact(
    spark: SparkSession, path: str, schema: T.StructType, days: Sequence[str], *, order: Sequence[str] = RAW_ORDER,
    date_name: str = "ingest_date", files: int | None = None, reduce: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """
    Rewrite days of a table beside it, for ``read_compacted``. Each day is written from the batches it has
    by now, and then noted as compacted up to the newest of them; that note is one file, so readers
    take the day's batches before it is there and the compacted day from then on.
    """
    upto = max(stored_batches(spark, path), default=None)
    if upto is None:
        return
    # A compaction goes to a folder of its own number, so that readers of an older one are not disturbed.
    target = f"{path}{COMPACTED}/upto={upto}"
    compact_days(spark, path, schema, days, target, order=order, date_name=date_name, files=files, reduce=reduce, upto=upto)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for day in days:
        note = jvm.org.apache.hadoop.fs.Path(f"{path}{COMPACTED}/_days/{day}={upto}")
        note.getFileSystem(conf).create(note, True).close()


def compacted_days(spark: SparkSession, path: str) -> dict[str, int]:
    """The newest batch that each compacted day covers."""
    found: dict[str, int] = {}
    for name in _names(spark, f"{path}{COMPACTED}/_days/*=*"):
        day, upto = name.split("=")
        found[day] = max(int(upto), found.get(day, -1))
    return found


def read_compacted(spark: SparkSession, path: str, schema: T.StructType, *, date_name: str = "ingest_date") -> DataFrame:
    """
    A table with its compacted days in place of the batches they were made of, and later batches of those days.

    Which days are compacted is known from names alone; batches a compacted day covers are not listed as files to read.
    """
    covered = compacted_days(spark, path)
    table = read_table(spark, path, schema, date_name=date_name)
    if not covered:
        return table
    upto = F.create_map(*[x for day, n in sorted(covered.items()) for x in (F.lit(day).cast("date"), F.lit(n).cast("long"))])
    newer = F.col(BATCH) > F.coalesce(F.try_element_at(upto, F.col(date_name)), F.lit(-1))
    out = table.filter(newer)
    for n in sorted(set(covered.values())):
        days = [F.lit(day).cast("date") for day, own in covered.items() if own == n]
        whole = read_table(spark, f"{path}{COMPACTED}/upto={n}", schema, date_name=date_name)
        out = out.unionByName(whole.filter(F.col(date_name).isin(*days)))
    return out


def dedup(
    edits: DataFrame, keys: Sequence[str] = ("kafka_partition", "kafka_offset"), order: str = "ingested_at"
) -> DataFrame:
    """
    One row per message: the copy that came first.

    The message coordinate is the key, not the ingest time, which can differ between
    copies. Coordinates are spread evenly and each task drops its own copies before the
    shuffle, so no group is larger than the tasks that saw the message.
    """
    copies = Window.partitionBy(*keys).orderBy(order)
    return edits.withColumn("_copy", F.row_number().over(copies)).filter("_copy = 1").drop("_copy")


def expired(df: DataFrame, column: str, days: int | None, as_of: AsOf = None) -> Column:
    """True for rows past their retention."""
    if days is None:
        return F.lit(False)
    return F.col(column) + F.make_dt_interval(days=F.lit(days)) <= as_of_column(df, column, as_of)


def retained(df: DataFrame, table: str, column: str, as_of: AsOf = None) -> DataFrame:
    """The rows of ``table`` that are still within its retention."""
    days = RETENTION_DAYS[table]
    if days is None:
        return df
    cutoff = as_of_column(df, column, as_of) - F.make_dt_interval(days=F.lit(days))
    return df.filter(F.col(column) > cutoff)


def expired_days(spark: SparkSession, path: str, table: str, as_of, date_name: str = "ingest_date") -> list[str]:
    """
    Date folders whose every row has expired. Reads folder names only; there is one per day.
    """
    from datetime import timedelta

    from tallybrook.functions.clock import day_of

    days = RETENTION_DAYS[table]
    if days is None:
        return []
    # A whole day is gone once its last instant is `days` old.
    limit = day_of(as_of) - timedelta(days=days + 1)
    return [d for d in stored_days(spark, path, date_name) if d <= limit.isoformat()]


def stored_days(spark: SparkSession, path: str, date_name: str = "ingest_date") -> list[str]:
    """The days a table has folders of, oldest first; there is one name per day, and no file is read."""
    prefix = f"{date_name}="
    return sorted(n[len(prefix):] for n in _names(spark, f"{path}/{prefix}*"))


def stored_batches(spark: SparkSession, path: str) -> list[int]:
    """The batches a table has folders of, by their names."""
    return sorted({int(n.split("=")[1]) for n in _names(spark, f"{path}/*/{BATCH}=*")})


def _names(spark: SparkSession, pattern: str) -> list[str]:
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob)
    return [s.getPath().getName() for s in found or ()]


def drop_expired(spark: SparkSession, path: str, table: str, as_of, date_name: str = "ingest_date") -> list[str]:
    """Delete the date folders named by ``expired_days``, compacted ones as well, and return the days."""
    gone = expired_days(spark, path, table, as_of, date_name)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for day in gone:
        # The note goes last: without it the day's batches would be read, with it nothing is left to read.
        for pattern in (f"{path}/{date_name}={day}", f"{path}{COMPACTED}/upto=*/{date_name}={day}", f"{path}{COMPACTED}/_days/{day}=*"):
            glob = jvm.org.apache.hadoop.fs.Path(pattern)
            files = glob.getFileSystem(conf)
            for found in files.globStatus(glob) or ():
                files.delete(found.getPath(), True)
    return gone
