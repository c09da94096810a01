"""Room readings derived from the ``events`` table, as columns and as raw messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.sources.files import stream_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    stream = stream_table(spark, sf_dir, "events", schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def epoch_seconds(ts: str = "ts") -> Column:
    return F.unix_micros(ts) / F.lit(1e6)


def mac() -> Column:
    return F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("mac")


def rssi() -> Column:
    return (-F.from_json("props", "k int")["k"]).alias("rssi")


def readings(source: DataFrame, thermometer: Column | None = None) -> DataFrame:
    """``event_id`` and the room reading, with epoch seconds in ``timestamp``.

    Where ``thermometer`` is NULL, so is the temperature.
    """
    temperature = (F.lit(10) + F.col("event_id") % 30).cast("double")
    if thermometer is not None:
        temperature = F.when(thermometer.isNotNull(), temperature)
    return source.select(
        "event_id",
        mac(),
        rssi(),
        temperature.alias("temperature"),
        (F.lit(30) + F.col("event_id") % 53).cast("double").alias("humidity"),
        (F.col("value") * 8).alias("light"),
        epoch_seconds().alias("timestamp"),
    )


def sightings(source: DataFrame) -> DataFrame:
    """Device and event time, for the occupancy windows."""
    return source.select(mac(), F.col("ts").alias("timestamp"))


def messages(source: DataFrame) -> DataFrame:
    """Readings as a message bus delivers them: JSON bytes in ``value``."""
    rows = readings(source)
    fields = [name for name in rows.columns if name != "event_id"]
    return rows.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        F.lit("room").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_seconds("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
