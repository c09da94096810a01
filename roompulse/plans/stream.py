"""Streaming queries: each drains what is there and returns the written result."""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import replace

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.config import ENV_TOPIC, MACS_TOPIC, OCCUPANCY_SUFFIX, RAW_SUFFIX
from roompulse.functions.ingest import parse_readings, stamped_records
from roompulse.operators.occupancy import exact_occupancy, occupancy_from_panes
from roompulse.plans import jobs
from roompulse.plans.batch import (
    CARRY_FORWARD_SQL, DAY, DAYS_SQL, FEED_COLUMNS, HALF_DAY, FIXED_MODEL, LABEL_SQL, OCCUPANCY_SQL, PROBABILITY_SQL,
    READING_SQL_COLUMNS, file_settings, held_against_exact,
    occupancy_text, sensor_feed, with_time_text,
)
from roompulse.plans.catalog import READINGS_SQL, query
from roompulse.plans.readings import events, events_stream, messages, readings, sightings
from roompulse.schemas import ROOM_READING, TRAINING_ROW
from roompulse.sinks.batch import write_lines, write_topic
from roompulse.sinks.stream import checkpoint_folder, drain, to_batches, to_csv, to_files, to_index, to_json_lines, to_topic
from roompulse.sources.files import read_appended_csv, read_lines, stream_lines
from roompulse.sources.index import read_index
from roompulse.sources.tail import tail_lines
from roompulse.sources.topics import once_only, replay_topic, stream_topic
from roompulse.streaming.carry_forward import KnownValues, carry_forward_batches
from roompulse.streaming.labelling import label_batches, labelled_readings
from roompulse.streaming.late import split_late
from roompulse.streaming.occupancy import (
    approximate_windows, block_windows, exact_windows, newest_windows, sketch_panes, sketched_windows,
)
from roompulse.streaming.outputs import csv_output, fan_out, table_output
from roompulse.streaming.routing import route_batches
from roompulse.streaming.scoring import score_batches, score_messages
from roompulse.streaming.watch import StreamWatch, watched_events
from roompulse.workspace import new_folder

SCORED_SQL = f"""
SELECT mac, rssi, temperature, humidity, light,
  CASE WHEN {PROBABILITY_SQL} > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
  CASE WHEN {PROBABILITY_SQL} > 0.5 THEN 'comfortable' ELSE 'not comfortable' END AS prediction_str,
  strftime(parsed_ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp
FROM readings"""

# Append mode emits a window once the watermark, one minute behind the newest event, has passed it.
CLOSED_SQL = f"""
SELECT * FROM ({OCCUPANCY_SQL})
WHERE window_end <= (SELECT strftime(max(ts) - INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S.%f') FROM events)"""


def readings_topic(spark: SparkSession, sf_dir: str, name: str):
    """Settings of a topic folder that holds all readings as messages."""
    settings = file_settings(spark, name)
    messages(events(spark, sf_dir)).write.parquet(settings.topic_path(settings.topic))
    return settings


# --- ingest and routing -----------------------------------------------------------------------

@query(READINGS_SQL + f"SELECT {READING_SQL_COLUMNS} FROM readings")
def json_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Follow a folder of JSON-lines logs and keep the parsed readings as JSON lines."""
    root = new_folder(spark, "json_tail")
    write_lines(messages(events(spark, sf_dir)).select(F.col("value").cast("string")), f"{root}/logs")
    rows = with_time_text(parse_readings(stream_lines(spark, f"{root}/logs"), ROOM_READING))
    drain(to_json_lines(rows, "json_tail", f"{root}/checkpoints", f"{root}/out"), spark)
    return spark.read.schema(rows.schema).json(f"{root}/out")


LOGS = 4


def grow_logs(lines: DataFrame, folder: str, before: dict[int, int] | None = None) -> dict[int, int]:
    """Append lines to ``LOGS`` files that were ``before`` long, one task each; a repeated task writes the same bytes again."""
    before = before or {}
    folder = folder.removeprefix("file://").removeprefix("file:")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/room-{number}.log", "r+b" if number in before else "w+b") as file:
            file.truncate(before.get(number, 0))
            file.seek(before.get(number, 0))
            for batch in batches:
                file.write("".join(f"{line}\n" for line in batch["value"].to_pylist()).encode())
            yield pa.RecordBatch.from_pydict({"number": [number], "size": [file.tell()]})

    return dict(lines.select("value").repartition(LOGS, "value").mapInArrow(write, "number long, size long").collect())


def in_two_deliveries(source: DataFrame) -> list[DataFrame]:
    """Events before and from the middle of their time on."""
    micros = F.unix_micros("ts")
    lo, hi = source.agg(F.min(micros), F.max(micros)).first()
    half = lo + (hi - lo) // 2
    return [source.filter(micros < half), source.filter(micros >= half)]


def log_lines(rows: DataFrame) -> DataFrame:
    return messages(rows).select(F.col("value").cast("string").alias("value"))


@query(READINGS_SQL + f"SELECT {READING_SQL_COLUMNS} FROM readings")
def json_tail_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Follow JSON logs that grow between two runs: what was appended to the same files is read on."""
    root = new_folder(spark, "json_tail_appended")
    sizes: dict[int, int] = {}
    for delivery in in_two_deliveries(events(spark, sf_dir)):
        sizes = grow_logs(log_lines(delivery), f"{root}/logs", sizes)
        rows = with_time_text(parse_readings(tail_lines(spark, f"{root}/logs"), ROOM_READING))
        drain(to_json_lines(rows, "json_tail_appended", f"{root}/checkpoints", f"{root}/out"), spark)
    return spark.read.schema(rows.schema).json(f"{root}/out")


@query(READINGS_SQL + "SELECT mac, rssi, temperature, humidity, light, 2 AS published FROM readings")
def ship_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship followed logs to a bus that gets every batch twice: readers get each record once."""
    root = new_folder(spark, "ship_once")
    settings = replace(file_settings(spark, "ship_once_topic"), follow_appended=True, once_within="1 hour")
    sizes: dict[int, int] = {}
    for delivery in in_two_deliveries(events(spark, sf_dir)):
        sizes = grow_logs(log_lines(delivery), f"{root}/logs", sizes)
        jobs.ship_log(spark, settings, f"{root}/logs", f"{root}/checkpoints", {"availableNow": True}).awaitTermination()
    # A bus takes a batch that is published again a second time.
    shipped = replay_topic(spark, settings).select("key", "value")
    for _ in range(2):
        write_topic(shipped, settings, "bus", whole=True)
    rows = parse_readings(once_only(stream_topic(spark, settings, "bus"), settings.once_within), ROOM_READING).drop("timestamp")
    drain(to_files(rows, "ship_once_read", f"{root}/checkpoints", f"{root}/out"), spark)
    times = replay_topic(spark, settings, "bus").count() // events(spark, sf_dir).count()
    return spark.read.parquet(f"{root}/out").withColumn("published", F.lit(times))


@query(READINGS_SQL + """
SELECT 'envData' AS route, event_id, NULL::INTEGER AS rssi, temperature, TRUE AS is_stamped FROM readings
UNION ALL SELECT 'macs', event_id, rssi, NULL, TRUE FROM readings""")
def route_log_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The routing job over followed logs: whole stamped records, each topic without the other's keys."""
    root = new_folder(spark, "route_log_job")
    settings = replace(file_settings(spark, "route_log_topics"), follow_appended=True)
    raw = readings(events(spark, sf_dir))
    grow_logs(raw.select(F.to_json(F.struct(*raw.columns)).alias("value")), f"{root}/logs")
    jobs.route_log(spark, settings, f"{root}/logs", f"{root}/checkpoints", {"availableNow": True}).awaitTermination()
    schema = "event_id long, rssi int, temperature double, timestamp double"
    parts = [
        replay_topic(spark, settings, topic).select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select(
            F.lit(topic).alias("route"), "r.event_id", "r.rssi", "r.temperature", (F.col("r.timestamp") > 1.7e9).alias("is_stamped"))
        for topic in (ENV_TOPIC, MACS_TOPIC)
    ]
    return parts[0].unionByName(parts[1])


@query("""
SELECT event_id, form, CASE WHEN form < 4 THEN text END AS logged, CASE WHEN form >= 4 THEN text END AS kept
FROM (
  SELECT event_id, event_id % 7 AS form, CASE event_id % 7
    WHEN 0 THEN '{"id":' || event_id || ',"a":1,"a":2}' WHEN 1 THEN '{"id":' || event_id || '} tail'
    WHEN 2 THEN '{"id":' || event_id || '}{"b":2}' WHEN 3 THEN '{"id":' || event_id || ',"timestamp":1,"a":1e400}'
    WHEN 4 THEN '{"id":' || event_id || ',"a":1e400}' WHEN 5 THEN '{"id":' || event_id || ',"a":1.10,"b":{"c":[ 1 ]}}'
    ELSE '{"id":' || event_id || ',"a":12345678901234567890123456789012345678901234}' END AS text
  FROM events
)""")
def ship_odd_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship lines that are not one JSON object, or hold numbers that parsers change: all of their text arrives."""
    root = new_folder(spark, "ship_odd_lines")
    settings = file_settings(spark, "ship_odd_lines_topic")
    tails = [',"a":1,"a":2}', "} tail", '}{"b":2}', ',"timestamp":1,"a":1e400}', ',"a":1e400}', ',"a":1.10,"b":{"c":[ 1 ]}}',
             ',"a":12345678901234567890123456789012345678901234}']
    form = F.col("event_id") % 7
    tail = F.element_at(F.array(*map(F.lit, tails)), (form + 1).cast("int"))
    write_lines(events(spark, sf_dir).select(F.concat(F.lit('{"id":'), "event_id", tail).alias("value")), f"{root}/logs")
    shipped = stamped_records(stream_lines(spark, f"{root}/logs"))
    drain(to_topic(shipped, "ship_odd_lines", f"{root}/checkpoints", settings, whole=True), spark)
    text = F.col("value").cast("string")
    found = replay_topic(spark, settings).select(
        F.get_json_object(text, "$.log").alias("logged"), F.regexp_replace(text, r',"timestamp":[0-9.]+\}$', "}").alias("whole"))
    event = F.regexp_extract(F.coalesce("logged", "whole"), r'"id":([0-9]+)', 1).cast("long")
    return found.select(event.alias("event_id"), (event % 7).alias("form"), "logged", F.when(F.col("logged").isNull(), F.col("whole")).alias("kept"))


@query(READINGS_SQL + """
SELECT 'sighted' AS side, mac, rssi, count(*) AS n FROM readings WHERE event_type <> 'error' GROUP BY ALL
UNION ALL SELECT 'rejected', mac, NULL, count(*) FROM readings WHERE event_type = 'error' GROUP BY ALL""")
def scans_to_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan lines converted to a log, shipped, and ingested as device sightings; broken lines are kept apart."""
    root = new_folder(spark, "scans")
    settings = file_settings(spark, "scans_topics")
    rows = readings(events(spark, sf_dir)).join(events(spark, sf_dir).select("event_id", "event_type"), "event_id")
    rssi = F.when(F.col("event_type") == "error", "strong").otherwise(F.col("rssi").cast("string"))
    write_lines(rows.select(F.concat_ws(",", "mac", rssi).alias("value")), f"{root}/scans")
    jobs.convert_scans(spark, f"{root}/scans", f"{root}/logs")
    once = {"availableNow": True}
    jobs.ship_log(spark, settings, f"{root}/logs", f"{root}/checkpoints", once).awaitTermination()
    jobs.ingest_devices(spark, settings, f"{root}/checkpoints", console=False, trigger=once).awaitTermination()
    sighted = read_index(spark, settings, settings.index + RAW_SUFFIX).select(F.lit("sighted").alias("side"), "mac", "rssi")
    rejected = read_lines(spark, f"{root}/logs_rejected").select(
        F.lit("rejected").alias("side"), F.split("value", ",")[0].alias("mac"), F.lit(None).cast("int").alias("rssi"))
    return sighted.unionByName(rejected).groupBy("side", "mac", "rssi").agg(F.count(F.lit(1)).alias("n"))


@query(READINGS_SQL + f"SELECT {READING_SQL_COLUMNS} FROM readings")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic to typed readings in an index."""
    settings = readings_topic(spark, sf_dir, "stream_ingest")
    rows = parse_readings(stream_topic(spark, settings), ROOM_READING)
    checkpoints = new_folder(spark, "stream_ingest_checkpoints")
    drain(to_index(rows, "stream_ingest", checkpoints, settings, "room"), spark)
    return with_time_text(read_index(spark, settings, "room"))


@query(READINGS_SQL + f"SELECT {READING_SQL_COLUMNS} FROM readings")
def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Follow a log folder and publish its readings to a topic as JSON values."""
    root = new_folder(spark, "stream_publish")
    settings = file_settings(spark, "stream_publish_topic")
    rows = readings(events_stream(spark, sf_dir)).drop("event_id")
    drain(to_topic(rows, "stream_publish", f"{root}/checkpoints", settings), spark)
    return with_time_text(parse_readings(replay_topic(spark, settings), ROOM_READING))


@query(READINGS_SQL + """
SELECT 'envData' AS route, NULL::VARCHAR AS mac, NULL::INTEGER AS rssi, temperature, humidity, light,
  strftime(parsed_ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp
FROM readings
UNION ALL
SELECT 'macs', mac, rssi, NULL, NULL, NULL, strftime(parsed_ts, '%Y-%m-%d %H:%M:%S.%f') FROM readings""")
def stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mixed stream to an environment table and a device table."""
    root = new_folder(spark, "stream_route")
    mixed = parse_readings(messages(events_stream(spark, sf_dir)), ROOM_READING)
    routes = route_batches(table_output(f"{root}/envData"), table_output(f"{root}/macs"))
    drain(to_batches(mixed, "stream_route", f"{root}/checkpoints", routes), spark)
    parts = [
        spark.read.parquet(f"{root}/{route}").drop("batch_id").withColumn("route", F.lit(route))
        for route in ("envData", "macs")
    ]
    return with_time_text(parts[0].unionByName(parts[1], allowMissingColumns=True))


@query(READINGS_SQL + f"""
SELECT CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'labelled' END AS side, count(*) AS n,
  sum(CASE WHEN event_type <> 'error' THEN CAST({LABEL_SQL} AS INTEGER) END)::BIGINT AS comfortable
FROM readings GROUP BY ALL""")
def label_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label a stream in which some readings lack the temperature: kept and rejected together are the input."""
    root = new_folder(spark, "label_stream_rejects")
    raw = readings(events_stream(spark, sf_dir), F.when(F.col("event_type") != "error", 1.0))
    lines = raw.select(F.to_json(F.struct(*[n for n in raw.columns if n != "event_id"])).alias("value"))
    both = label_batches(csv_output(f"{root}/labelled"), table_output(f"{root}/rejected"))
    drain(to_batches(lines, "label_stream_rejects", f"{root}/checkpoints", both), spark)
    labelled = read_appended_csv(spark, f"{root}/labelled", TRAINING_ROW)
    rejected = spark.read.parquet(f"{root}/rejected")
    return labelled.agg(F.lit("labelled").alias("side"), F.count(F.lit(1)).alias("n"), F.sum("comfortable").alias("comfortable")).unionByName(
        rejected.agg(F.lit("rejected").alias("side"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("comfortable"))
    ).filter("n > 0")


@query(READINGS_SQL + """
SELECT event_id, rssi, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS kind,
  event_type = 'error' AS is_log, TRUE AS is_stamped
FROM readings""")
def ship_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship records with undeclared keys and lines that are no JSON: every one arrives whole, with the time."""
    root = new_folder(spark, "ship_passthrough")
    settings = file_settings(spark, "ship_passthrough_topic")
    rows = readings(events(spark, sf_dir)).join(events(spark, sf_dir).select("event_id", "event_type"), "event_id")
    record = F.to_json(F.struct("event_id", "rssi", F.col("event_type").alias("kind")))
    broken = F.concat_ws(" ", F.lit("broken"), "event_id", "rssi")
    write_lines(rows.select(F.when(F.col("event_type") == "error", broken).otherwise(record).alias("value")), f"{root}/logs")
    shipped = stamped_records(stream_lines(spark, f"{root}/logs"))
    drain(to_topic(shipped, "ship_passthrough", f"{root}/checkpoints", settings, whole=True), spark)
    text = F.col("value").cast("string")
    found = replay_topic(spark, settings).select(
        F.from_json(text, "event_id long, rssi int, kind string, log string, timestamp double").alias("r")).select("r.*")
    words = F.split("log", " ")
    return found.select(
        F.coalesce("event_id", F.get(words, F.lit(1)).cast("long")).alias("event_id"),
        F.coalesce("rssi", F.get(words, F.lit(2)).cast("int")).alias("rssi"), "kind",
        F.col("log").isNotNull().alias("is_log"), (F.col("timestamp") > 1.7e9).alias("is_stamped"))


@query(f"""
SELECT 'occupancy' AS source, window_start AS place, distinct_macs::DOUBLE AS value FROM ({CLOSED_SQL})
UNION ALL
SELECT 'scores', timestamp || mac || rssi, prediction FROM ({READINGS_SQL} {SCORED_SQL})""")
def shared_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and occupancy run on the same settings; both are read back whole."""
    settings = readings_topic(spark, sf_dir, "shared_settings")
    checkpoints = new_folder(spark, "shared_settings_checkpoints")
    once = {"availableNow": True}
    jobs.live_scores(spark, settings, FIXED_MODEL, checkpoints, console=False, trigger=once).awaitTermination()
    for running in jobs.occupancy(spark, settings, checkpoints, trigger=once, form="exact"):
        running.awaitTermination()
    windows = occupancy_text(read_index(spark, settings, settings.index + OCCUPANCY_SUFFIX))
    scores = with_time_text(read_index(spark, settings).withColumn("timestamp", F.to_timestamp("timestamp")))
    return windows.select(
        F.lit("occupancy").alias("source"), F.col("window_start").alias("place"), F.col("distinct_macs").cast("double").alias("value")
    ).unionByName(scores.select(
        F.lit("scores").alias("source"), F.concat("timestamp", "mac", F.col("rssi").cast("string")).alias("place"),
        F.col("prediction").alias("value")))


@query(READINGS_SQL + f"""
SELECT light, temperature, humidity, CAST({LABEL_SQL} AS INTEGER) AS comfortable FROM readings""")
def label_stream_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label a stream of readings and append it to CSV files with headers."""
    root = new_folder(spark, "label_stream")
    rows = labelled_readings(messages(events_stream(spark, sf_dir)))
    drain(to_csv(rows, "label_stream_csv", f"{root}/checkpoints", f"{root}/out"), spark)
    return read_appended_csv(spark, f"{root}/out", TRAINING_ROW)


# --- scoring ----------------------------------------------------------------------------------

@query(READINGS_SQL + SCORED_SQL)
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score a topic with fixed weights into an index."""
    settings = readings_topic(spark, sf_dir, "stream_score")
    scored, _ = score_messages(stream_topic(spark, settings), FIXED_MODEL)
    checkpoints = new_folder(spark, "stream_score_checkpoints")
    drain(to_index(scored, "stream_score", checkpoints, settings), spark)
    return with_time_text(read_index(spark, settings))


@query(READINGS_SQL + SCORED_SQL)
def stream_foreach_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score inside a per-batch callback."""
    root = new_folder(spark, "stream_foreach_batch")
    rows = parse_readings(messages(events_stream(spark, sf_dir)), ROOM_READING)
    callback = score_batches(
        FIXED_MODEL, table_output(f"{root}/scored"), table_output(f"{root}/rejected")
    )
    drain(to_batches(rows, "stream_foreach_batch", f"{root}/checkpoints", callback), spark)
    return with_time_text(spark.read.parquet(f"{root}/scored").drop("batch_id"))


@query(READINGS_SQL + f"""
SELECT sink, s.* FROM ({SCORED_SQL}) s, (VALUES ('index'), ('topic')) t(sink)""")
def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scoring pass feeds two sinks."""
    root = new_folder(spark, "stream_fanout")
    scored, _ = score_messages(messages(events_stream(spark, sf_dir)), FIXED_MODEL)
    outputs = fan_out([table_output(f"{root}/index"), table_output(f"{root}/topic", "orc")])
    drain(to_batches(scored, "stream_fanout", f"{root}/checkpoints", outputs), spark)
    index = spark.read.parquet(f"{root}/index").withColumn("sink", F.lit("index"))
    topic = spark.read.orc(f"{root}/topic").withColumn("sink", F.lit("topic"))
    return with_time_text(index.unionByName(topic).drop("batch_id"))


@query(READINGS_SQL + f"""
SELECT event_id,
  CASE WHEN event_type = 'error' THEN NULL WHEN {PROBABILITY_SQL} > 0.5 THEN 1.0::DOUBLE
    ELSE 0.0::DOUBLE END AS prediction,
  CASE WHEN event_type = 'error' THEN 'rejected' WHEN {PROBABILITY_SQL} > 0.5 THEN 'comfortable'
    ELSE 'not comfortable' END AS prediction_str
FROM readings""")
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings without a temperature go to the reject table, the rest is scored."""
    root = new_folder(spark, "stream_rejects")
    source = events_stream(spark, sf_dir)
    raw = readings(source, F.when(F.col("event_type") != "error", 1.0)).withColumn(
        "mac", F.col("event_id").cast("string")
    )
    raw = raw.select(F.to_json(F.struct(*[n for n in raw.columns if n != "event_id"])).alias("value"))
    callback = score_batches(
        FIXED_MODEL, table_output(f"{root}/scored"), table_output(f"{root}/rejected")
    )
    rows = parse_readings(raw, ROOM_READING)
    drain(to_batches(rows, "stream_rejects", f"{root}/checkpoints", callback), spark)
    scored = spark.read.parquet(f"{root}/scored")
    rejected = spark.read.parquet(f"{root}/rejected").withColumns({
        "prediction": F.lit(None).cast("double"), "prediction_str": F.lit("rejected"),
    })
    return scored.unionByName(rejected).select(
        F.col("mac").cast("long").alias("event_id"), "prediction", "prediction_str"
    )


# --- occupancy --------------------------------------------------------------------------------

@query(CLOSED_SQL)
def occupancy_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact occupancy in append mode: every window that the watermark has closed."""
    root = new_folder(spark, "occupancy_stream")
    windows = exact_windows(sightings(events_stream(spark, sf_dir)))
    drain(to_files(windows, "occupancy_stream", f"{root}/checkpoints", f"{root}/out"), spark)
    return occupancy_text(spark.read.parquet(f"{root}/out"))


# Append mode emits a day's window once the watermark has passed it.
CLOSED_DAYS_SQL = f"""
SELECT * FROM ({DAYS_SQL})
WHERE window_end <= (SELECT strftime(max(ts) - INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S.%f') FROM events)"""


@query(CLOSED_DAYS_SQL)
def occupancy_stream_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production stream: one sketch per open window."""
    root = new_folder(spark, "occupancy_stream_approx")
    windows = approximate_windows(
        sightings(events_stream(spark, sf_dir)), window_seconds=DAY, slide_seconds=HALF_DAY)
    drain(to_files(windows, "occupancy_stream_approx", f"{root}/checkpoints", f"{root}/out"), spark)
    return held_against_exact(spark, sf_dir, spark.read.parquet(f"{root}/out"))


@query(CLOSED_DAYS_SQL)
def occupancy_stream_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode with mergeable sketches per pane."""
    root = new_folder(spark, "occupancy_stream_sketched")
    windows = sketched_windows(
        sightings(events_stream(spark, sf_dir)), window_seconds=DAY, slide_seconds=HALF_DAY)
    drain(to_files(windows, "occupancy_stream_sketched", f"{root}/checkpoints", f"{root}/out"), spark)
    return held_against_exact(spark, sf_dir, spark.read.parquet(f"{root}/out"))


@query(OCCUPANCY_SQL)
def occupancy_stream_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows, newest first: the closed ones of the output, the open ones read from the stream's state."""
    root = new_folder(spark, "occupancy_complete")
    windows = block_windows(sightings(events_stream(spark, sf_dir)))
    drain(to_files(windows, "occupancy_stream_complete", f"{root}/checkpoints", f"{root}/out"), spark)
    checkpoint = checkpoint_folder(f"{root}/checkpoints", "occupancy_stream_complete")
    return occupancy_text(newest_windows(spark, checkpoint, spark.read.parquet(f"{root}/out")))


# Devices enough for windows of hundreds: the events fall into ten minutes, from one of 997 devices each.
CROWD, CROWD_SECONDS = 997, 600


def crowd(source: DataFrame) -> DataFrame:
    seconds = F.floor(F.unix_micros("ts") / F.lit(1e6)).cast("long") % CROWD_SECONDS
    return source.select(
        F.concat(F.lit("m"), (F.col("event_id") % CROWD).cast("string")).alias("mac"),
        F.timestamp_seconds(F.lit(1_704_067_200) + seconds).alias("timestamp"))


CROWD_SQL = f"""
  SELECT 'm' || event_id % {CROWD} AS mac, make_timestamp((1704067200 + (epoch_us(ts) // 1000000) % {CROWD_SECONDS}) * 1000000) AS ts
  FROM events"""


def exact_and_close(windows: DataFrame, exact: DataFrame, error: float) -> DataFrame:
    """Exact counts of estimated windows, and whether the estimate is within three standard errors, of a hundred at least."""
    found = exact.select("start", "end", F.col("distinct_macs").alias("devices")).join(windows, ["start", "end"])
    bound = 3 * error * F.greatest("devices", F.lit(100))
    return found.select(
        F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), F.date_format("end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        "devices", (F.abs(F.col("distinct_macs") - F.col("devices")) <= bound).alias("is_close"))


@query(f"""
WITH crowd AS ({CROWD_SQL})
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL 2 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
  count(DISTINCT mac) AS devices, TRUE AS is_close
FROM (SELECT time_bucket(INTERVAL 30 SECOND, ts) - to_seconds(30 * i) AS s, mac FROM crowd, range(4) t(i))
WHERE s + INTERVAL 2 MINUTE <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM crowd)
GROUP BY s""")
def occupancy_stream_crowd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production stream on windows of two minutes every 30 seconds, each with hundreds of devices."""
    root = new_folder(spark, "occupancy_stream_crowd")
    windows = approximate_windows(crowd(events_stream(spark, sf_dir)))
    drain(to_files(windows, "occupancy_stream_crowd", f"{root}/checkpoints", f"{root}/out"), spark)
    return exact_and_close(spark.read.parquet(f"{root}/out"), exact_occupancy(crowd(events(spark, sf_dir))), 0.05)


PANE_SPANS = {"2 minutes": (120, 30), "an hour": (3600, 1800), "a day": (86_400, 43_200)}
PANE_PARTS = " UNION ALL ".join(f"""
SELECT '{name}' AS span, strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(s + INTERVAL {size} SECOND, '%Y-%m-%d %H:%M:%S') AS window_end, count(DISTINCT user_id) AS devices, TRUE AS is_close
FROM (SELECT time_bucket(INTERVAL {slide} SECOND, ts) - to_seconds({slide} * i) AS s, user_id FROM kept, range({size // slide}) t(i)) GROUP BY s"""
                               for name, (size, slide) in PANE_SPANS.items())


@query(f"""
WITH kept AS (
  SELECT ts, user_id FROM events
  WHERE time_bucket(INTERVAL 30 SECOND, ts) + INTERVAL 30 SECOND <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM events)
) {PANE_PARTS}""")
def occupancy_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table of kept pane sketches, written by a stream; windows of three sizes are read from it without the readings."""
    root = new_folder(spark, "occupancy_panes")
    panes = sketch_panes(sightings(events_stream(spark, sf_dir)))
    drain(to_files(panes, "occupancy_panes", f"{root}/checkpoints", f"{root}/panes"), spark)
    panes = spark.read.parquet(f"{root}/panes")
    closed = sightings(events(spark, sf_dir)).withColumn("pane", F.window("timestamp", "30 seconds"))
    closed = closed.withColumn("pane_start", F.col("pane.start")).join(panes.select("pane_start"), "pane_start", "left_semi")
    out = None
    for name, (size, slide) in PANE_SPANS.items():
        # 2 ** 12 registers: a standard error of 1.6 %.
        found = exact_and_close(occupancy_from_panes(panes, size, slide), exact_occupancy(closed, size, slide), 0.016)
        found = found.withColumn("span", F.lit(name))
        out = found if out is None else out.unionByName(found)
    return out


def arrive(rows: DataFrame, folder: str) -> None:
    """The next files of a growing folder."""
    rows.write.mode("append").parquet(folder)


LATE_SQL = """
WITH span AS (
  SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi, max(ts) AS newest FROM events
), on_time AS (
  SELECT ts, user_id FROM events, span
  WHERE NOT (event_type = 'error' AND epoch_us(ts) < lo + (hi - lo) // 4)
)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(s + INTERVAL 2 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
  count(DISTINCT user_id) AS distinct_macs, round(count(DISTINCT user_id) / 3.0::DOUBLE, 6) AS approx_people
FROM (
  SELECT time_bucket(INTERVAL 30 SECOND, ts) - to_seconds(30 * i) AS s, user_id
  FROM on_time, range(4) t(i)
)
WHERE s + INTERVAL 2 MINUTE <= (SELECT newest - INTERVAL 1 MINUTE FROM span)
GROUP BY s"""


@query(LATE_SQL)
def late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in three deliveries; the last one also brings old ones, which the watermark drops."""
    root = new_folder(spark, "late_drop")
    source = events(spark, sf_dir)
    for rows in late_deliveries(source):
        arrive(sightings(rows), f"{root}/in")
        stream = spark.readStream.schema(sightings(source).schema).parquet(f"{root}/in")
        drain(to_files(exact_windows(stream), "late_drop", f"{root}/checkpoints", f"{root}/out"), spark)
    return occupancy_text(spark.read.parquet(f"{root}/out"))


LATE_SIDES_SQL = """
WITH span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
d AS (
  SELECT event_id, ts, CASE WHEN event_type = 'error' AND epoch_us(ts) < lo + (hi - lo) // 4 THEN 3
    WHEN epoch_us(ts) < lo + (hi - lo) // 2 THEN 1 WHEN epoch_us(ts) < lo + (hi - lo) // 4 * 3 THEN 2 ELSE 3 END AS n
  FROM events, span
)
SELECT event_id, n > 1 AND ts < (SELECT max(ts) FROM d AS e WHERE e.n < d.n) - INTERVAL 1 MINUTE AS is_late FROM d"""


def late_deliveries(source: DataFrame) -> list[DataFrame]:
    """Three deliveries; the last one also brings old events of one kind."""
    micros = F.unix_micros("ts")
    lo, hi = source.agg(F.min(micros), F.max(micros)).first()
    late = (F.col("event_type") == "error") & (micros < lo + (hi - lo) // 4)
    half, three_quarters = lo + (hi - lo) // 2, lo + (hi - lo) // 4 * 3
    return [
        source.filter(~late & (micros < half)),
        source.filter(~late & (micros >= half) & (micros < three_quarters)),
        source.filter(late | (micros >= three_quarters)),
    ]


@query(LATE_SIDES_SQL)
def late_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in three deliveries: those on time and those behind the watermark are two tables, together the input."""
    root = new_folder(spark, "late_kept")
    split = split_late(table_output(f"{root}/on_time"), table_output(f"{root}/late"), f"{root}/newest")
    for rows in late_deliveries(events(spark, sf_dir)):
        rows = rows.select("event_id", F.col("ts").alias("timestamp"))
        arrive(rows, f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        drain(to_batches(stream, "late_kept", f"{root}/checkpoints", split), spark)
    sides = [spark.read.parquet(f"{root}/{side}").select("event_id", F.lit(side == "late").alias("is_late")) for side in ("on_time", "late")]
    return sides[0].unionByName(sides[1])


@query("""
SELECT 'watch_failing' AS query, 'failed' AS event, 1 AS n, TRUE AS has_detail WHERE EXISTS (FROM events WHERE event_type = 'error')
UNION ALL SELECT 'watch_late', 'dropped', 1, FALSE
UNION ALL SELECT 'watch_late', 'stopped', 3, FALSE""")
def watch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that fails and one that drops late rows, run under a watch; what happened is read from its table."""
    root = new_folder(spark, "watch_table")
    source = events(spark, sf_dir)
    watch = StreamWatch(spark, f"{root}/events").start()
    try:
        failing = events_stream(spark, sf_dir).select(
            F.when(F.col("event_type") == "error", F.raise_error(F.lit("a reading that stops the stream"))).otherwise(F.col("event_id")).alias("id"))
        try:
            drain(to_files(failing, "watch_failing", f"{root}/checkpoints", f"{root}/failing"), spark)
        except StreamingQueryException:
            pass  # the table tells
        for rows in late_deliveries(source):
            arrive(sightings(rows), f"{root}/in")
            stream = spark.readStream.schema(sightings(source).schema).parquet(f"{root}/in")
            drain(to_files(exact_windows(stream), "watch_late", f"{root}/checkpoints", f"{root}/out"), spark)
    finally:
        watch.stop()
    found = watched_events(spark, f"{root}/events").filter("event <> 'started' AND query LIKE 'watch_%'")
    return found.groupBy("query", "event").agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.max(F.col("detail").contains("a reading that stops")).alias("has_detail")
    ).select("query", "event", "n", F.coalesce("has_detail", F.lit(False)).alias("has_detail"))


@query(CLOSED_SQL)
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop half-way and go on from the checkpoint: the result is that of one run."""
    root = new_folder(spark, "stream_restart")
    source = events(spark, sf_dir)
    micros = F.unix_micros("ts")
    lo, hi = source.agg(F.min(micros), F.max(micros)).first()
    half = lo + (hi - lo) // 2
    for rows in (source.filter(micros < half), source.filter(micros >= half)):
        arrive(sightings(rows), f"{root}/in")
        stream = spark.readStream.schema(sightings(source).schema).parquet(f"{root}/in")
        drain(
            to_files(exact_windows(stream), "stream_restart", f"{root}/checkpoints", f"{root}/out"), spark
        )
    return occupancy_text(spark.read.parquet(f"{root}/out"))


# --- carry-forward ----------------------------------------------------------------------------

def filled_in_deliveries(spark: SparkSession, sf_dir: str, name: str, deliveries: list[DataFrame]) -> DataFrame:
    """Carry-forward on a stream that gets the readings in several deliveries, from one checkpoint; a day is a segment."""
    root = new_folder(spark, name)
    known = KnownValues(spark, f"{root}/known")
    fill = carry_forward_batches(
        table_output(f"{root}/out"), known, "user_id", ["ts", "event_id"], FEED_COLUMNS, F.to_date("ts"))
    for rows in deliveries:
        arrive(sensor_feed(rows), f"{root}/in")
        stream = spark.readStream.schema(sensor_feed(rows).schema).parquet(f"{root}/in")
        drain(to_batches(stream, name, f"{root}/checkpoints", fill), spark)
    return spark.read.parquet(f"{root}/out").drop("ts", "batch_id")


@query(CARRY_FORWARD_SQL)
def locf_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carry-forward over two micro-batches, with the last known values of each device between them."""
    return filled_in_deliveries(spark, sf_dir, "locf_stream", in_two_deliveries(events(spark, sf_dir)))


# A row takes the latest value at or before it, of its own delivery or of the newest entry of the one before.
LATE_FILL_SQL = """
WITH span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
feed AS (
  SELECT event_id, user_id, ts,
    CASE WHEN event_type = 'view' THEN value END AS light,
    CASE WHEN event_type = 'error' THEN value END AS temperature,
    CASE WHEN event_type = 'click' THEN CAST(-CAST(props::JSON->>'k' AS INTEGER) AS INTEGER) END AS rssi,
    CASE WHEN epoch_us(ts) < lo + (hi - lo) // 2 AND event_id % 5 > 0 THEN 1 ELSE 2 END AS delivery
  FROM events, span
), state AS (
  SELECT user_id,
    max(struct_pack(ts, event_id, v := light)) FILTER (WHERE light IS NOT NULL) AS light,
    max(struct_pack(ts, event_id, v := temperature)) FILTER (WHERE temperature IS NOT NULL) AS temperature,
    max(struct_pack(ts, event_id, v := rssi)) FILTER (WHERE rssi IS NOT NULL) AS rssi
  FROM feed WHERE delivery = 1 GROUP BY user_id
), own AS (
  SELECT f.*,
    last_value(CASE WHEN light IS NOT NULL THEN struct_pack(ts, event_id, v := light) END IGNORE NULLS) OVER w AS own_light,
    last_value(CASE WHEN temperature IS NOT NULL THEN struct_pack(ts, event_id, v := temperature) END IGNORE NULLS) OVER w AS own_temperature,
    last_value(CASE WHEN rssi IS NOT NULL THEN struct_pack(ts, event_id, v := rssi) END IGNORE NULLS) OVER w AS own_rssi
  FROM feed f WINDOW w AS (PARTITION BY user_id, delivery ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT event_id, user_id,
  CASE WHEN usable_light AND (own_light IS NULL OR (own_light.ts, own_light.event_id) < (s_light.ts, s_light.event_id)) THEN s_light.v ELSE own_light.v END AS light,
  CASE WHEN usable_temperature AND (own_temperature IS NULL OR (own_temperature.ts, own_temperature.event_id) < (s_temperature.ts, s_temperature.event_id)) THEN s_temperature.v ELSE own_temperature.v END AS temperature,
  CASE WHEN usable_rssi AND (own_rssi IS NULL OR (own_rssi.ts, own_rssi.event_id) < (s_rssi.ts, s_rssi.event_id)) THEN s_rssi.v ELSE own_rssi.v END AS rssi
FROM (
  SELECT own.*, state.light AS s_light, state.temperature AS s_temperature, state.rssi AS s_rssi,
    delivery = 2 AND state.light IS NOT NULL AND (state.light.ts, state.light.event_id) <= (own.ts, own.event_id) AS usable_light,
    delivery = 2 AND state.temperature IS NOT NULL AND (state.temperature.ts, state.temperature.event_id) <= (own.ts, own.event_id) AS usable_temperature,
    delivery = 2 AND state.rssi IS NOT NULL AND (state.rssi.ts, state.rssi.event_id) <= (own.ts, own.event_id) AS usable_rssi
  FROM own LEFT JOIN state USING (user_id)
)"""


@query(LATE_FILL_SQL)
def locf_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carry-forward where the second delivery also brings old readings: they never see or hide newer values."""
    source = events(spark, sf_dir)
    micros = F.unix_micros("ts")
    lo, hi = source.agg(F.min(micros), F.max(micros)).first()
    first = (micros < lo + (hi - lo) // 2) & (F.col("event_id") % 5 > 0)
    return filled_in_deliveries(spark, sf_dir, "locf_stream_late", [source.filter(first), source.filter(~first)])
