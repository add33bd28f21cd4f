"""Validation, projection and routing of JSON change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Verdicts on one payload. Blank payloads are keep-alives: skipped and not counted.
OK = "ok"
BLANK = "blank"
UNPARSEABLE = "unparseable"
INVALID = "invalid"


_PAYLOAD = "array<struct<id:bigint,type:string,title:string,wiki:string,user:string,timestamp:double,bot:boolean>>"
_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}

# Text that a JSON number, boolean, array or object would also be read as.
_MAYBE_NOT_TEXT = r"^([-+0-9.\[{]|true$|false$|NaN$|Inf)"

# Raw JSON of the values that count as false, besides false itself.
_FALSY = r'^(null|""|\[\]|\{\}|-?0(\.0+)?([eE][+-]?[0-9]+)?)$'


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """
    Add a column that is computed once. A generated column is never inlined: as a plain
    projection, every later filter would be pushed below it and evaluate it again.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def _wrapped(value: Column) -> Column:
    """The payload as a one-element array, so that text after its end is an error."""
    return F.concat(F.lit("["), value, F.lit("]"))


def _member(value: Column, name: str) -> Column:
    """One field of the payload with its JSON type."""
    return F.try_variant_get(F.try_parse_json(_wrapped(value)), f"$[0].{name}", "variant")


def _text(value: Column, read: Column, name: str, scalars: bool = False) -> Column:
    """A JSON string or, with ``scalars``, a number or boolean as it is written; else null."""
    exact = _member(value, name)
    kind = F.schema_of_variant(exact)
    fits = ~kind.rlike("^(VOID|ARRAY|OBJECT)") if scalars else kind == "STRING"
    return F.when(read.rlike(_MAYBE_NOT_TEXT), F.when(fits, exact.cast("string"))).otherwise(read)


def _truthy(value: Column, read: Column, name: str) -> Column:
    """Truthiness of any JSON value: absent, null, false, 0, "", [] and {} are false."""
    exact = _member(value, name)
    return F.coalesce(read, F.when(exact.isNull(), False).otherwise(~F.to_json(exact).rlike(_FALSY)))


def _clock(value: Column, read: Column, name: str) -> Column:
    """Whole epoch seconds of a numeric clock: a fraction is floored, text is null."""
    exact = _member(value, name)
    infinite = F.isnan(read) | (F.abs(read) == float("inf"))
    return F.when(read.isNotNull(), F.when(~infinite, F.floor(read))).otherwise(
        F.when(F.schema_of_variant(exact) == "BOOLEAN", exact.try_cast("long"))
    )


def judge(payloads: DataFrame, value: str = "value") -> DataFrame:
    """
    Add ``verdict`` and the projected ``event`` struct (null unless the verdict is ok).

    A payload must be a JSON object with a ``wiki`` that is a non-empty string and a ``type``
    that is one, or a number or boolean, which counts as its text; everything else is optional. All of it runs on JVM expressions. Payloads are read once
    with a declared schema; only a field whose type that reading leaves in doubt, or a
    payload that is refused, is looked at again.
    """
    text = F.col(value)
    parsed = _once(payloads, "_items", F.from_json(_wrapped(text), _PAYLOAD, _STRICT))
    parsed = _once(parsed, "_p", F.when(F.size("_items") == 1, F.col("_items")[0])).drop("_items")
    there = F.col("_p").isNotNull()
    fields = F.struct(
        _text(text, F.col("_p.type"), "type", scalars=True).alias("type"),
        _text(text, F.col("_p.wiki"), "wiki").alias("wiki"),
        F.when(there, _clock(text, F.col("_p.timestamp"), "timestamp")).alias("timestamp"),
        F.when(there, _truthy(text, F.col("_p.bot"), "bot")).alias("bot"),
    )
    parsed = _once(parsed, "_f", fields)
    whole = F.try_parse_json(_wrapped(text))
    verdict = (
        F.when((F.col("_f.type") != "") & (F.col("_f.wiki") != ""), OK)
        .when(~F.coalesce(text, F.lit("")).rlike(r"\S"), BLANK)
        .when(whole.isNull() | F.try_variant_get(whole, "$[1]", "variant").isNotNull(), UNPARSEABLE)
        .otherwise(INVALID)
    )
    event = F.struct("_p.id", "_f.type", "_p.title", "_f.wiki", "_p.user", "_f.timestamp", "_f.bot")
    return (
        _once(parsed, "verdict", verdict)
        .withColumn("event", F.when(F.col("verdict") == OK, event))
        .drop("_p", "_f")
    )


def project(payloads: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The seven fields of every usable payload, after any ``keep`` columns."""
    return judge(payloads, value).filter(F.col("verdict") == OK).select(*keep, "event.*")


def dropped_by_reason(payloads: DataFrame, value: str = "value") -> DataFrame:
    """How many payloads were refused, per reason."""
    return (
        judge(payloads, value)
        .filter(F.col("verdict").isin(UNPARSEABLE, INVALID))
        .groupBy(F.col("verdict").alias("reason"))
        .agg(F.count("*").alias("dropped"))
    )


def judged(messages: DataFrame) -> DataFrame:
    """The envelope with ``error`` and ``event``, from raw upstream payloads."""
    verdicts = judge(messages).filter(F.col("verdict") != BLANK)
    return verdicts.withColumn(
        "error", F.when(F.col("verdict") == OK, F.lit("")).otherwise(F.col("verdict"))
    ).drop("verdict")


def observe_drops(judged: DataFrame, name: str = "payloads") -> DataFrame:
    """Count accepted and refused payloads as they pass, for the query's progress reports."""
    return judged.observe(
        name,
        F.count_if(F.col("error") == "").alias("accepted"),
        F.count_if(F.col("error") == UNPARSEABLE).alias(UNPARSEABLE),
        F.count_if(F.col("error") == INVALID).alias(INVALID),
    )


def clean_rows(parsed: DataFrame, now: Column | None = None) -> DataFrame:
    """
    Rows without an error, shaped as ``edits``. The broker's clock is the ingest time;
    ``now`` (one value per micro-batch) stands in where the broker gave none.
    """
    kind = parsed.schema["timestamp"].dataType
    now = (F.current_timestamp() if now is None else now).cast(kind)
    return parsed.filter(F.col("error") == "").select(
        F.coalesce(F.col("timestamp"), now).alias("ingested_at"),
        F.timestamp_seconds("event.timestamp").cast(kind).alias("event_time"),
        "event.wiki",
        "event.type",
        "event.title",
        "event.user",
        "event.id",
        "event.bot",
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def dead_letters(parsed: DataFrame, now: Column | None = None) -> DataFrame:
    """Exactly the rows that ``clean_rows`` leaves out, with their raw text and the reason."""
    return parsed.filter(F.col("error") != "").select(
        (F.current_timestamp() if now is None else now).alias("seen_at"),
        "topic",
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        "error",
        F.col("value").alias("raw_message"),
    )


def keyed(events: DataFrame) -> DataFrame:
    """Events as (key, value) messages: the wiki as key, compact JSON as value."""
    fields = [F.col(f) for f in ("id", "type", "title", "wiki", "user", "timestamp", "bot")]
    return events.select(
        F.col("wiki").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )
