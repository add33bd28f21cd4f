"""Stream sources and the topic sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.schemas import ENVELOPE
from tallybrook.settings import TOPIC, TOPIC_PARTITIONS

KAFKA_COLUMNS = ("topic", "partition", "offset", "timestamp")


def kafka_options(
    servers: str, topic: str = TOPIC, *, starting: str = "latest", per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        # Expired offsets surface as an error instead of a silent hole.
        "failOnDataLoss": "true",
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def read_topic(
    spark: SparkSession, servers: str, topic: str = TOPIC, *, starting: str = "latest",
    per_trigger: int | None = None,
) -> DataFrame:
    """
    The topic as an envelope stream. Each query that reads it keeps its own checkpoint
    and so its own position: the live path starts at ``latest``, the stored path at
    ``earliest``, which backfills all that the topic still holds.
    """
    reader = spark.readStream.format("kafka")
    for key, value in kafka_options(servers, topic, starting=starting, per_trigger=per_trigger).items():
        reader = reader.option(key, value)
    return reader.load().select(*KAFKA_COLUMNS, F.col("value").cast("string").alias("value"))


def read_landed(spark: SparkSession, path: str, *, files_per_trigger: int | None = None) -> DataFrame:
    """The same envelope from Parquet files that land in a folder."""
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def publish_topic(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Write keyed messages to the topic; the broker's partitioner keeps a wiki together."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("kafka.compression.type", "gzip")
        .option("kafka.linger.ms", "50")
        .option("topic", topic)
        .save()
    )


def publish_files(messages: DataFrame, path: str, partitions: int = TOPIC_PARTITIONS) -> None:
    """
    Land keyed messages as Parquet, the topic partition a function of the key. Only the
    number is assigned: rows are not gathered by it, so a busy wiki stays spread over tasks.
    """
    (
        messages.withColumn("partition", F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int"))
        .write.mode("append")
        .partitionBy("partition")
        .parquet(path)
    )
