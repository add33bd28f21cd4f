"""Declared schemas. Nothing in the engine infers one."""

from pyspark.sql import types as T

# A message as it travels on the topic: seven fields.
EVENT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("wiki", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("bot", T.BooleanType()),
])

ENVELOPE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.StringType()),
])

EDITS = T.StructType([
    T.StructField("ingested_at", T.TimestampType(), False),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("wiki", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("bot", T.BooleanType(), False),
    T.StructField("kafka_partition", T.IntegerType(), False),
    T.StructField("kafka_offset", T.LongType(), False),
])

DEAD_LETTERS = T.StructType([
    T.StructField("seen_at", T.TimestampType(), False),
    T.StructField("topic", T.StringType()),
    T.StructField("kafka_partition", T.IntegerType(), False),
    T.StructField("kafka_offset", T.LongType(), False),
    T.StructField("error", T.StringType(), False),
    T.StructField("raw_message", T.StringType()),
])

# What a batch of the stored path holds of a topic partition.
BATCHES = T.StructType([
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("low", T.LongType()),
    T.StructField("high", T.LongType()),
    T.StructField("messages", T.LongType()),
    T.StructField("newest", T.TimestampType()),
])

_ROLLUP = [
    T.StructField("wiki", T.StringType(), False),
    T.StructField("edits", T.LongType(), False),
    T.StructField("bot_edits", T.LongType(), False),
    T.StructField("new_pages", T.LongType(), False),
    T.StructField("editors", T.BinaryType()),
]
MINUTE_ROLLUP = T.StructType([T.StructField("minute", T.TimestampType(), False), *_ROLLUP])
DAY_ROLLUP = T.StructType([T.StructField("day", T.DateType(), False), *_ROLLUP])

EDITOR_NUMBERS = T.StructType([T.StructField("user", T.StringType(), False), T.StructField("number", T.LongType(), False)])
DAY_EDITORS = T.StructType([
    T.StructField("day", T.DateType(), False),
    T.StructField("wiki", T.StringType(), False),
    T.StructField("bucket", T.LongType(), False),
    T.StructField("bitmap", T.BinaryType(), False),
])

COUNTS = T.ArrayType(T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("count", T.LongType()),
]))
TOP_USERS = T.ArrayType(T.StructType([
    T.StructField("user", T.StringType()),
    T.StructField("count", T.LongType()),
]))
SLICE = T.StructType([
    T.StructField("window_start", T.LongType(), False),
    T.StructField("window_end", T.LongType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("total_edits", T.LongType(), False),
    T.StructField("edits_per_second", T.DoubleType()),
    T.StructField("edits_per_wiki", COUNTS),
    T.StructField("bot_vs_human", T.StructType([
        T.StructField("bot", T.LongType()),
        T.StructField("human", T.LongType()),
    ])),
    T.StructField("edit_types", COUNTS),
    T.StructField("top_editors", TOP_USERS),
    T.StructField("written_at", T.TimestampType()),
])

# Up to where the windows of a partition have been written.
LAST_WINDOWS = T.StructType([T.StructField("partition", T.IntegerType()), T.StructField("window_start", T.LongType())])

# One scraped sample of a counter, gauge or histogram bucket.
SAMPLES = T.StructType([
    T.StructField("ts", T.TimestampType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("le", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
])
