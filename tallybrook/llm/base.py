"""What the operators share: table access, intermediate tables, words, spans."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.session import shared_folder

# Separators of words made of ASCII letters, digits and everything beyond ASCII.
WORD_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A word no text holds: the separators include it.
SENTINEL = "\x00"

BROADCAST_BYTES = 64 * 1024 * 1024


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python once a session, as they may not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_tallybrook_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    handle, name = tempfile.mkstemp(prefix="tallybrook-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(name, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(name)
    context._tallybrook_shipped = True


_tables: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """
    Write ``df`` to the folder all executors share and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before. The tables of a
    session are in one folder, and may be removed once the result that reads them is written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark, 'llm')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _tables.append(path)
    return spark.read.schema(df.schema).parquet(path)


def tables_so_far() -> int:
    return len(_tables)


def remove_stored(spark: SparkSession, since: int, keep: int = 0) -> None:
    """Remove the tables stored since ``tables_so_far`` gave ``since``, but for the last ``keep``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _tables[since:len(_tables) - keep]:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


HOT_SHARE = 1024


def spread_join(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """
    ``rows`` with the columns of ``facts``, which has one row per ``key``; a left join in which
    null keys meet. ``rows`` should be a written table, as it is read three times.

    Keys with more than one in ``HOT_SHARE`` of all rows, of which there are fewer than
    ``HOT_SHARE`` at any size of the input, get their facts by broadcast; the others by a shuffle, in
    which no key is large.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    hot = stored(counts.filter(F.col("n") * HOT_SHARE > rows.count()).select(F.col(key).alias("hot_key")), "hot-keys")
    other = [c for c in facts.columns if c != key]
    facts = facts.withColumnRenamed(key, "fact_key")

    def hot_rows(df: DataFrame, name: str, how: str) -> DataFrame:
        return df.join(F.broadcast(hot), df[name].eqNullSafe(hot["hot_key"]), how)

    few, many = hot_rows(rows, key, "left_semi"), hot_rows(rows, key, "left_anti")
    own = F.broadcast(hot_rows(facts, "fact_key", "left_semi"))
    joined = few.join(own, F.col(key).eqNullSafe(F.col("fact_key")), "left").unionByName(
        many.join(facts, F.col(key).eqNullSafe(F.col("fact_key")), "left"))
    return joined.select(*rows.columns, *other)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column) -> Column:
    """Words with an empty string where the text starts or ends with a separator."""
    return F.split(F.coalesce(text, F.lit("")), WORD_GAP, -1)


def scan_words(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """
    One row for each word of ``docs(doc_id, text)`` that is a ``word`` of ``keys``, and one
    row per document for ``SENTINEL``, which ``keys`` must hold.

    The words are exploded and met with the broadcast keys within one stage, so only matches
    leave it. ``pos`` counts words from 0 (for the sentinel: the number of words), ``words``
    are the words as written, ``text_key`` tells texts of the same id apart.
    """
    parts = docs.select("doc_id", F.xxhash64("text").alias("text_key"),
                        split_words(F.col("text")).alias("parts"))
    lead = F.when(F.col("parts")[0] == "", 1).otherwise(0)
    size = F.size("parts")
    tail = F.when((size > 1) & (F.element_at("parts", -1) == ""), 1).otherwise(0)
    words = parts.withColumn("lead", lead).withColumn("n_words", size - lead - tail).select(
        "doc_id", "text_key", "n_words", "lead",
        F.concat("parts", F.array(F.lit(SENTINEL))).alias("words"))
    found = words.select("doc_id", "text_key", "n_words", "lead", "words",
                         F.posexplode("words").alias("at", "written"))
    met = found.join(F.broadcast(keys), F.lower("written") == F.col("word"))
    return met.withColumn("pos", F.when(F.col("word") == SENTINEL, F.col("n_words"))
                          .otherwise(F.col("at") - F.col("lead")).cast("long"))


def words_between(start: Column, count: Column) -> Column:
    """The lower-cased words from ``start`` (0-based) on, joined by blanks; rows of ``scan_words``."""
    return ascii_lower(F.array_join(F.slice("words", start + F.col("lead") + 1, count), " "))


def covered(spans: Column) -> Column:
    """Positions covered by sorted spans (start, end exclusive), each counted once."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(
        spans, zero,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(s["start"], a["upto"]))).alias("n"),
            F.greatest(a["upto"], s["end"]).alias("upto")),
        lambda a: a["n"])
