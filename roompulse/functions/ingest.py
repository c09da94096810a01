"""From raw messages to typed columns and back."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roompulse.schemas import DOCUMENT_ID

# Fixed value: the timestamp text of the output documents.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSZ"


def message_text(value: Column | str = "value") -> Column:
    """A message's bytes as UTF-8 text."""
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def with_document_id(messages: DataFrame) -> DataFrame:
    """Add ``document_id``: topic, partition and offset, which a replay gives again."""
    place = F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return messages.withColumn(DOCUMENT_ID, place)


def parse_messages(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parse each JSON message once and expand the declared keys to columns.

    A missing key, a wrong type for one key or a malformed message gives NULLs, never an error;
    keys that the schema does not declare are ignored. A document id is kept.
    """
    kept = [DOCUMENT_ID] if DOCUMENT_ID in messages.columns else []
    parsed = F.from_json(message_text(value), schema).alias("parsed_value")
    return messages.select(*kept, parsed).select(*kept, "parsed_value.*")


def parse_readings(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parsed messages with the epoch seconds in ``timestamp`` made a timestamp."""
    return parse_messages(messages, schema, value).withColumn(
        "timestamp", epoch_to_timestamp("timestamp")
    )


def epoch_to_timestamp(epoch: Column | str) -> Column:
    """Epoch seconds, with a fraction, as a timestamp."""
    return (F.col(epoch) if isinstance(epoch, str) else epoch).cast("timestamp")


def iso_text(timestamp: Column | str) -> Column:
    """ISO-8601 text with milliseconds and offset, in the session's time zone."""
    return F.date_format(timestamp, ISO_PATTERN)


def timestamp_text(timestamp: Column | str) -> Column:
    """Spark's plain text of a timestamp."""
    return (F.col(timestamp) if isinstance(timestamp, str) else timestamp).cast("string")


def scan_line(line: Column | str = "value") -> Column:
    """A ``mac,rssi`` scan line as a struct; NULL as a whole when rssi is not a whole number.

    Fields after the second are ignored, and spaces around the number are allowed.
    """
    fields = F.split(line, ",", -1)
    rssi = F.trim(F.get(fields, F.lit(1))).try_cast("int")
    return F.when(rssi.isNotNull(), F.struct(F.get(fields, F.lit(0)).alias("mac"), rssi.alias("rssi")))


def to_json_value(df: DataFrame, *columns: str) -> DataFrame:
    """Rows as JSON text in the column ``value``, NULL keys included."""
    chosen = columns or tuple(df.columns)
    return df.select(F.to_json(F.struct(*chosen), {"ignoreNullFields": "false"}).alias("value"))


def as_bytes(messages: DataFrame) -> DataFrame:
    """Messages as a topic holds them: ``value``, and ``key`` where there is one, as bytes."""
    return messages.select(*(F.col(c).cast("binary").alias(c) for c in ("key", "value") if c in messages.columns))


def message_key() -> Column:
    """An id of a followed line: its file, its place there and its text, which reading it again gives again."""
    text = F.coalesce(F.col("value"), F.lit(""))
    return F.concat_ws("-", "source", F.col("position").cast("string"), F.hex(F.xxhash64(text))).cast("binary")


def _whole_object(text: Column) -> Column:
    """The keys of a text that is one JSON object from end to end, else NULL.

    The parser stops after the first value, so the text is set between a key and a last key that only
    the end of the whole can give.
    """
    seal = F.md5(text)
    sealed = F.try_parse_json(F.concat(F.lit('{"r":'), text, F.lit(',"'), seal, F.lit('":0}')))
    parts = F.try_variant_get(sealed, "$", "map<string,variant>")
    whole = F.regexp_like(text, F.lit(r"^\s*\{")) & F.map_contains_key(parts, seal) & (F.size(parts) == 2)
    return F.when(whole, F.try_variant_get(sealed, "$.r", "map<string,variant>"))


def _same_numbers(text: Column, record: Column) -> Column:
    """Whether a parsed record still has all digits: numbers beyond 38 digits or a double's range lose some."""
    again = F.to_json(record)
    long_runs, infinite = F.lit("[0-9.]{39,}"), F.lit('"-?Infinity"')
    return (F.regexp_count(again, long_runs) >= F.regexp_count(text, long_runs)) & (
        F.regexp_count(again, infinite) <= F.regexp_count(text, infinite))


def stamped_records(
    lines: DataFrame, value: str = "value", name: str = "timestamp", without: tuple[str, ...] = ()
) -> DataFrame:
    """Whole records with the time of ingestion added, as JSON text in ``value``; a column ``key`` is passed on.

    Every key of a JSON object is passed on, declared or not, except those in ``without``; a time of its own is
    replaced. An object that loses no key keeps its text as it came. A line that is not one JSON object from end to end, has a
    key twice or, where keys have to go, a number that can't be written again becomes a record with the line under ``log``.
    """
    kept = ["key"] if "key" in lines.columns else []
    text = message_text(value)
    seconds = (F.unix_micros(F.current_timestamp()) / F.lit(1e6)).cast("decimal(20,6)").cast("string")
    parsed = lines.select(*kept, text.alias("text"), _whole_object(text).alias("record"))
    leaves = F.lit(False)
    for key in (name, *without):
        leaves = leaves | F.map_contains_key("record", key)
    body = F.regexp_replace(F.regexp_replace("text", r"\s*\}\s*$", ""), r"^\s+", "")
    added = F.concat(F.lit(f"{json.dumps(name)}:"), seconds, F.lit("}"))
    spliced = F.concat(body, F.when(F.size("record") > 0, ",").otherwise(""), added)
    now = F.parse_json(seconds)
    shorter = F.map_filter("record", lambda key, _: ~key.isin(name, *without))
    rebuilt = F.to_json(F.map_concat(shorter, F.create_map(F.lit(name), now)))
    line = F.create_map(F.lit("log"), F.try_parse_json(F.to_json(F.array("text"))).cast("array<variant>")[0])
    logged = F.to_json(F.map_concat(F.map_filter(line, lambda key, _: ~key.isin(name, *without)), F.create_map(F.lit(name), now)))
    return parsed.select(*kept, (
        F.when(F.col("record").isNull(), logged).when(~leaves, spliced)
        .when(_same_numbers(F.col("text"), F.col("record")), rebuilt).otherwise(logged)).alias("value"))


def with_ingest_time(df: DataFrame, name: str = "timestamp") -> DataFrame:
    """Add the time of ingestion as epoch seconds, the same for all rows of a batch."""
    return df.withColumn(name, F.unix_micros(F.current_timestamp()) / F.lit(1e6))
