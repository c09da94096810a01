"""The jobs a user submits. Streams start and return; the caller waits for them.

``trigger`` is passed on to Structured Streaming, e.g. ``{"availableNow": True}``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roompulse.config import ENV_INDEX, ENV_TOPIC, MACS_TOPIC, OCCUPANCY_SUFFIX, RAW_SUFFIX, Settings
from roompulse.functions.ingest import (
    iso_text, message_key, parse_readings, scan_line, stamped_records, with_document_id,
)
from roompulse.functions.logs import DOCKER_FIELDS, matched_json_log, matched_log, matched_logfmt
from roompulse.functions.scoring import LinearModel
from roompulse.operators.comfort_model import (
    Report, complete_and_rejected, evaluate, linear_model, load, save_if_good, score, train, usable_and_rejected,
)
from roompulse.operators.evaluation import confusion_counts
from roompulse.operators.export import EXPORT_ROWS, first_documents
from roompulse.operators.occupancy import occupancy_from_panes
from roompulse.operators.split import random_split
from roompulse.schemas import (
    DEVICE_SIGHTING, DOCUMENT_ID, ENVIRONMENT_READING, ROOM_READING, TRAINING_ROW,
)
from roompulse.sinks.batch import write_csv, write_json_lines, write_lines, write_topic
from roompulse.sinks.stream import checkpoint_folder, start, to_batches, to_console, to_files, to_index, to_topic
from roompulse.sources.files import read_appended_csv, read_lines, stream_lines, two_field_rows
from roompulse.sources.index import read_index
from roompulse.sources.tail import tail_lines
from roompulse.sources.topics import once_only, replay_topic, stream_topic
from roompulse.streaming.labelling import label_batches
from roompulse.streaming.late import split_late
from roompulse.streaming.occupancy import approximate_windows, exact_windows, newest_windows, sketch_panes, sketched_windows
from roompulse.streaming.outputs import (
    console_output, csv_output, fan_out, index_output, table_output, topic_output,
)
from roompulse.streaming.routing import route_records
from roompulse.streaming.scoring import score_batches

Trigger = dict | None


def _messages(spark: SparkSession, settings: Settings, topic: str | None = None) -> DataFrame:
    """A topic's stream; messages of a bus have a place in it, which becomes their document id."""
    messages = stream_topic(spark, settings, topic)
    if settings.once_within is not None:
        messages = once_only(messages, settings.once_within)
    return with_document_id(messages) if settings.stream_format == "kafka" else messages


def _log_lines(spark: SparkSession, settings: Settings, logs: str) -> DataFrame:
    """New lines of the logs; those of followed files have an id, which becomes their message's key."""
    if settings.follow_appended:
        return tail_lines(spark, logs).select(message_key().alias("key"), "value")
    return stream_lines(spark, logs, **settings.file_source_options())


def ship_log(
    spark: SparkSession, settings: Settings, logs: str, checkpoints: str, trigger: Trigger = None
) -> StreamingQuery:
    """Follow a folder of JSON logs and publish every record whole, stamped with the time of ingestion."""
    rows = stamped_records(_log_lines(spark, settings, logs))
    return start(to_topic(rows, "ship_log", checkpoints, settings, whole=True), spark, trigger)


def route_log(
    spark: SparkSession, settings: Settings, logs: str, checkpoints: str, trigger: Trigger = None
) -> StreamingQuery:
    """Follow a folder of JSON logs and publish each record twice, without its device and its sensor keys."""
    routes = route_records(topic_output(settings, ENV_TOPIC, True), topic_output(settings, MACS_TOPIC, True))
    lines = _log_lines(spark, settings, logs)
    return start(to_batches(lines, "route_log", checkpoints, routes), spark, trigger)


def publish_scans(spark: SparkSession, settings: Settings, path: str) -> None:
    """Publish headerless ``mac,rssi`` lines as messages."""
    write_topic(two_field_rows(read_lines(spark, path), "mac_address", "rssi"), settings, MACS_TOPIC)


def convert_scans(spark: SparkSession, path: str, logs: str) -> None:
    """Headerless ``mac,rssi`` lines as JSON readings in a folder that the shipping job follows.

    Lines whose rssi is no whole number go to ``<logs>_rejected`` as they came. The lines are parsed once.
    """
    lines = read_lines(spark, path).select("value", scan_line().alias("scan"))
    record = F.to_json("scan", {"ignoreNullFields": "false"})
    sides = lines.select(F.coalesce(record, "value").alias("value"), F.col("scan").isNotNull().alias("whole")).persist()
    try:
        write_lines(sides.filter("whole").select("value"), logs)
        write_lines(sides.filter("not whole").select("value"), f"{logs}_rejected")
    finally:
        sides.unpersist()


def dump_topic(spark: SparkSession, settings: Settings, path: str) -> None:
    """Everything in a topic, from the beginning, as text of the messages."""
    values = replay_topic(spark, settings).select(F.col("value").cast("string").alias("message"))
    write_json_lines(values, path)


def ingest_environment(
    spark: SparkSession, settings: Settings, checkpoints: str, console: bool = True,
    trigger: Trigger = None,
) -> StreamingQuery:
    """Environment topic to its index, with ISO time."""
    rows = parse_readings(_messages(spark, settings, ENV_TOPIC), ENVIRONMENT_READING)
    return _to_index_and_console(
        spark, rows, "ingest_environment", settings, ENV_INDEX, checkpoints, console, trigger
    )


def ingest_devices(
    spark: SparkSession, settings: Settings, checkpoints: str, console: bool = True,
    trigger: Trigger = None,
) -> StreamingQuery:
    """Device topic to its raw index, with ISO time."""
    rows = parse_readings(_messages(spark, settings), DEVICE_SIGHTING)
    return _to_index_and_console(
        spark, rows, "ingest_devices", settings, settings.index + RAW_SUFFIX, checkpoints, console, trigger
    )


def _to_index_and_console(
    spark: SparkSession, rows: DataFrame, name: str, settings: Settings, index: str, checkpoints: str,
    console: bool, trigger: Trigger,
) -> StreamingQuery:
    documents = rows.withColumn("timestamp", iso_text("timestamp"))
    if console:
        documents.printSchema()
    outputs = [index_output(settings, index)] + ([console_output()] if console else [])
    return start(to_batches(documents, name, checkpoints, fan_out(outputs)), spark, trigger)


OCCUPANCY_FORMS = {
    "approx": approximate_windows,
    "sketched": sketched_windows,
    "exact": exact_windows,
}


def occupancy(
    spark: SparkSession,
    settings: Settings,
    checkpoints: str,
    console: bool = False,
    trigger: Trigger = None,
    form: str = "approx",
    **window_options,
) -> list[StreamingQuery]:
    """Closed windows to an index of their own, ``<index>_occupancy``; with ``console`` all windows to it too.

    ``form`` chooses how the index's devices are counted; ``window_options`` are those of the forms.
    Complete mode keeps every window's sketch for ever and reads the topic again, so the console is
    off unless asked for; the newest windows are those of the index, latest start first.
    """
    sightings = parse_readings(_messages(spark, settings), DEVICE_SIGHTING).drop(DOCUMENT_ID)
    windows = OCCUPANCY_FORMS[form](sightings, **window_options)
    id_column = None
    if settings.index_format == "es":
        id_column = DOCUMENT_ID
        windows = windows.withColumn(DOCUMENT_ID, iso_text("start"))
    index = settings.index + OCCUPANCY_SUFFIX
    writer = to_index(windows, "occupancy", checkpoints, settings, index, id_column)
    queries = [start(writer, spark, trigger)]
    if console:
        newest = approximate_windows(sightings, **window_options).orderBy(F.col("start").desc())
        writer = to_console(newest, "occupancy_console", checkpoints, mode="complete")
        queries.append(start(writer, spark, trigger))
    return queries


def newest_occupancy(spark: SparkSession, settings: Settings, checkpoints: str) -> DataFrame:
    """All windows of the exact form, newest first: the closed ones of the index, the open ones of the stream's state."""
    closed = read_index(spark, settings, settings.index + OCCUPANCY_SUFFIX).withColumns(
        {name: F.col(name).cast("timestamp") for name in ("start", "end")})
    return newest_windows(spark, checkpoint_folder(checkpoints, "occupancy"), closed)


def keep_panes(
    spark: SparkSession, settings: Settings, path: str, checkpoints: str, trigger: Trigger = None, **pane_options
) -> StreamingQuery:
    """One sketch of the devices per pane to a table, from which ``pane_occupancy`` reads any windows later."""
    sightings = parse_readings(_messages(spark, settings), DEVICE_SIGHTING).drop(DOCUMENT_ID)
    return start(to_files(sketch_panes(sightings, **pane_options), "keep_panes", checkpoints, path), spark, trigger)


def pane_occupancy(spark: SparkSession, path: str, **window_options) -> DataFrame:
    """Windows of any size from kept panes, newest first."""
    return occupancy_from_panes(spark.read.parquet(path), **window_options).orderBy(F.col("start").desc())


def keep_late(
    spark: SparkSession, settings: Settings, path: str, checkpoints: str, delay: str, trigger: Trigger = None
) -> StreamingQuery:
    """The device topic as two tables below ``path``: ``on_time``, for windows, and ``late``, which they would drop."""
    rows = parse_readings(_messages(spark, settings), DEVICE_SIGHTING).drop(DOCUMENT_ID)
    split = split_late(table_output(f"{path}/on_time"), table_output(f"{path}/late"), f"{path}/newest", delay=delay)
    return start(to_batches(rows, "keep_late", checkpoints, split), spark, trigger)


def label_log(
    spark: SparkSession, settings: Settings, logs: str, path: str, checkpoints: str,
    trigger: Trigger = None,
) -> StreamingQuery:
    """Follow a folder of JSON logs and append labelled training rows to CSV files.

    Lines without all sensor values go to ``<path>_rejected`` as they came.
    """
    both = label_batches(csv_output(path), table_output(f"{path}_rejected"))
    lines = _log_lines(spark, settings, logs).select("value")
    return start(to_batches(lines, "label_log", checkpoints, both), spark, trigger)


def train_model(
    spark: SparkSession, training_csv: str, model_path: str | None = None, rejects: str | None = None
) -> tuple[PipelineModel, Report, bool]:
    """Split, fit, evaluate on the held-out rows, and save when the model beats the gate.

    Rows without all features or a label of 0 or 1 are counted in the report, and written to ``rejects``.
    """
    rows = read_appended_csv(spark, training_csv, TRAINING_ROW, text="line")
    usable, rejected = usable_and_rejected(rows)
    if rejects is not None:
        write_csv(rejected, rejects)
    train_rows, test_rows = random_split(usable.drop("line"))
    model = train(train_rows)
    report = replace(evaluate(score(test_rows, model)), rejected=rejected.count())
    saved = model_path is not None and save_if_good(model, report, model_path)
    return model, report, saved


def score_file(
    spark: SparkSession, csv: str, model_path: str, rejects: str | None = None, features: list[str] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Score rows with a saved model: the scored rows, their confusion counts, and the rejected rows.

    ``features`` states the order of a model that was saved without its assembler.
    A row needs all features to be scored; one without a label is scored too, and counted under NULL.
    """
    rows = read_appended_csv(spark, csv, TRAINING_ROW, text="line")
    complete, rejected = complete_and_rejected(rows)
    if rejects is not None:
        write_csv(rejected, rejects)
    scored = score(complete.drop("line"), load(model_path, features))
    return scored, confusion_counts(scored, "comfortable"), rejected


def live_scores(
    spark: SparkSession,
    settings: Settings,
    model: PipelineModel | LinearModel,
    checkpoints: str,
    strict: bool = False,
    console: bool = True,
    trigger: Trigger = None,
) -> StreamingQuery:
    """Score the room topic into the index and to the console in one pass.

    Readings with a missing feature go to ``<index>_rejected``. ``strict`` keeps them in the feed,
    so the job fails on the first one.
    """
    if isinstance(model, PipelineModel) and not strict:
        model = linear_model(model)
    rows = parse_readings(_messages(spark, settings), ROOM_READING)
    outputs = [index_output(settings)] + ([console_output()] if console else [])
    rejects = index_output(settings, f"{settings.index}_rejected")
    # The readings are held by the callback; scoring them again for another output is arithmetic.
    callback = score_batches(model, fan_out(outputs, kept=True), rejects, strict)
    return start(to_batches(rows, "live_scores", checkpoints, callback), spark, trigger)


def export_index(
    spark: SparkSession, settings: Settings, index: str, path: str, first: bool = False
) -> int:
    """Export an index as quoted CSV: all documents, or only the first 1,000. Returns the total."""
    documents = read_index(spark, settings, index)
    # Counted by a scan of its own: an observation on the write would leave the session unable to run fitted models.
    total = documents.count()
    write_csv(first_documents(documents, documents.columns, EXPORT_ROWS) if first else documents, path)
    return total


def export_indices(
    spark: SparkSession, settings: Settings, indices: list[str], path: str, first: bool = False
) -> dict[str, int]:
    """Several indices, each to a folder of its name below ``path``; the totals by index."""
    return {index: export_index(spark, settings, index, f"{path}/{index}", first) for index in indices}


def parse_logs(
    spark: SparkSession, logs: str, name: str, path: str, fields: list[str] | None = None
) -> None:
    """Log lines of a format as JSON lines below ``path``, parsed and rejected ones in a part each, from one pass.

    ``logfmt`` and ``json`` have no fixed fields: name those to keep, for JSON with a type if it isn't text (``"k int"``). A
    rejected line is kept as it came.
    """
    lines = read_lines(spark, logs)
    if name == "logfmt":
        rows = matched_logfmt(lines, fields or [])
    elif name == "docker":
        rows = matched_json_log(lines, DOCKER_FIELDS)
    elif name == "json":
        if not fields:
            raise ValueError("name the keys of the JSON lines to keep")
        rows = matched_json_log(lines, ", ".join(field if " " in field else f"`{field}` string" for field in fields))
    else:
        rows = matched_log(lines, name)
    kept = F.when(~F.col("matched"), F.col("value")).alias("value")
    rows.select(kept, "fields", "matched").write.partitionBy("matched").json(path)
