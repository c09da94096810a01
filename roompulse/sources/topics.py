"""Message topics. The format comes from the settings: a message bus, or files of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.config import Settings
from roompulse.schemas import ENVELOPE


def stream_topic(
    spark: SparkSession, settings: Settings, topic: str | None = None, **options: str
) -> DataFrame:
    """A topic as an unbounded table; the start offset is the bus default (latest) unless given."""
    topic = topic or settings.topic
    reader = spark.readStream.format(settings.stream_format)
    if settings.stream_format == "kafka":
        return reader.options(**settings.kafka_source_options(topic)).options(**options).load()
    files = reader.schema(ENVELOPE).options(**settings.file_source_options()).options(**options)
    return files.load(settings.topic_path(topic))


def replay_topic(
    spark: SparkSession, settings: Settings, topic: str | None = None, **options: str
) -> DataFrame:
    """Everything a topic holds, from the beginning, as a bounded table."""
    topic = topic or settings.topic
    reader = spark.read.format(settings.stream_format)
    if settings.stream_format == "kafka":
        source = settings.kafka_source_options(topic, from_beginning=True)
        return reader.options(**source).options(**options).load()
    return reader.schema(ENVELOPE).options(**options).load(settings.topic_path(topic))


def once_only(messages: DataFrame, within: str) -> DataFrame:
    """A stream of messages in which one that was published again within a time comes once.

    Copies of a message have its key. A message without a key is told apart by its place in the topic, and without that it is
    taken as it is. The time is that of reading: event times would let a partition that lags behind lose its messages. The
    state holds one key per message read in the last ``within``; a copy that comes later is a message of its own.
    """
    place = F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    own = F.when(F.col("partition").isNotNull() & F.col("offset").isNotNull(), place).otherwise(F.uuid())
    named = messages.withColumns({
        "_once": F.when(F.col("key").isNotNull(), F.concat(F.lit("k"), F.hex("key"))).otherwise(F.concat(F.lit("p"), own)),
        "_came": F.current_timestamp(),
    })
    return named.withWatermark("_came", within).dropDuplicatesWithinWatermark(["_once"]).select(*messages.columns)
