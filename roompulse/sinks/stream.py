"""Streaming outputs. Every query has its own checkpoint folder, named after the query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from roompulse.config import Settings
from roompulse.functions.ingest import as_bytes, to_json_value
from roompulse.session import session_conf, state_conf

BatchFunction = Callable[[DataFrame, int], None]


def checkpoint_folder(checkpoint_root: str, query_name: str) -> str:
    return f"{checkpoint_root}/{query_name}"


def _writer(df: DataFrame, name: str, checkpoint_root: str, mode: str) -> DataStreamWriter:
    return (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint_folder(checkpoint_root, name))
    )


def to_console(df: DataFrame, name: str, checkpoint_root: str, mode: str = "append") -> DataStreamWriter:
    """The first 20 rows of each micro-batch on the driver's console."""
    return _writer(df, name, checkpoint_root, mode).format("console")


def to_files(
    df: DataFrame, name: str, checkpoint_root: str, path: str, file_format: str = "parquet", **options
) -> DataStreamWriter:
    """Append to a folder of part files; the sink's log makes replays exactly-once."""
    return (
        _writer(df, name, checkpoint_root, "append")
        .format(file_format)
        .options(**options)
        .option("path", path)
    )


def to_csv(df: DataFrame, name: str, checkpoint_root: str, path: str) -> DataStreamWriter:
    return to_files(df, name, checkpoint_root, path, "csv", header="true", escape='"')


def to_json_lines(df: DataFrame, name: str, checkpoint_root: str, path: str) -> DataStreamWriter:
    return to_files(df, name, checkpoint_root, path, "json", ignoreNullFields="false")


def to_index(
    df: DataFrame, name: str, checkpoint_root: str, settings: Settings, index: str | None = None,
    id_column: str | None = None,
) -> DataStreamWriter:
    """Append to an index. With an id column a replayed batch overwrites its own documents."""
    index = index or settings.index
    if settings.index_format != "es":
        return to_files(df, name, checkpoint_root, settings.index_path(index), settings.index_format)
    options = settings.index_options()
    if id_column is not None:
        options |= {"es.mapping.id": id_column, "es.mapping.exclude": id_column}
    return (
        _writer(df, name, checkpoint_root, "append")
        .format("es")
        .options(**options)
        .option("path", index)
    )


def to_topic(
    df: DataFrame, name: str, checkpoint_root: str, settings: Settings, topic: str | None = None,
    whole: bool = False,
) -> DataStreamWriter:
    """Publish rows as JSON values; ``whole`` rows have their JSON text in ``value`` already."""
    topic = topic or settings.topic
    messages = df if whole else to_json_value(df)
    if settings.stream_format == "kafka":
        return (
            _writer(messages, name, checkpoint_root, "append")
            .format("kafka")
            .options(**settings.kafka_sink_options(topic))
        )
    messages = as_bytes(messages)
    return to_files(messages, name, checkpoint_root, settings.topic_path(topic), settings.stream_format)


def to_batches(
    df: DataFrame, name: str, checkpoint_root: str, function: BatchFunction, mode: str = "append"
) -> DataStreamWriter:
    """Call ``function(batch, batch_id)`` for each micro-batch."""
    return _writer(df, name, checkpoint_root, mode).foreachBatch(function)


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def committed_batches(spark, path: str) -> list[int]:
    """Numbers of the batches with a committed folder below a path."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    files = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(make(path)):
        return []
    folders = [status.getPath() for status in files.listStatus(make(path))]
    return sorted(int(f.getName().split("=")[1]) for f in folders if files.exists(make(f, "_SUCCESS")))


def drop_batches(spark, path: str, before: int) -> None:
    """Delete the folders of batches before a number."""
    for batch_id in committed_batches(spark, path):
        if batch_id < before:
            folder = spark._jvm.org.apache.hadoop.fs.Path(batch_folder(path, batch_id))
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_batch(df: DataFrame, path: str, batch_id: int, file_format: str = "parquet") -> None:
    """Write one micro-batch to its own folder, so a replayed batch replaces itself."""
    df.write.mode("overwrite").format(file_format).save(batch_folder(path, batch_id))


def start(writer: DataStreamWriter, spark, trigger: dict | None = None) -> StreamingQuery:
    """Start a query with the state settings of ``session.state_conf``."""
    if trigger:
        writer = writer.trigger(**trigger)
    with session_conf(spark, state_conf(spark)):
        return writer.start()


def drain(writer: DataStreamWriter, spark) -> StreamingQuery:
    """Process everything that is there now, then stop; a failed batch raises here."""
    query = start(writer, spark, {"availableNow": True})
    query.awaitTermination()
    return query
