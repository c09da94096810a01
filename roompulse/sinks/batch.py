"""Batch outputs. Every writer keeps the partitions of its input: no coalesce, no driver collect."""

from __future__ import annotations

from pyspark.sql import DataFrame

from roompulse.config import Settings
from roompulse.functions.ingest import as_bytes, to_json_value


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> None:
    """Quoted CSV part files, each with a header row."""
    df.write.mode(mode).option("header", header).option("escape", '"').csv(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One string column as text lines."""
    df.write.mode(mode).text(path)


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Save as a catalog table, managed unless a path is given."""
    writer = df.write.mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_topic(df: DataFrame, settings: Settings, topic: str | None = None, whole: bool = False) -> None:
    """Publish rows as JSON values; ``whole`` rows have their JSON text in ``value`` already."""
    topic = topic or settings.topic
    messages = df if whole else to_json_value(df)
    if settings.stream_format == "kafka":
        messages.write.format("kafka").options(**settings.kafka_sink_options(topic)).save()
    else:
        as_bytes(messages).write.mode("append").format(settings.stream_format).save(settings.topic_path(topic))


def write_index(
    df: DataFrame, settings: Settings, index: str | None = None, id_column: str | None = None
) -> None:
    """Append rows to an index as documents; with an id column a rewrite replaces documents."""
    index = index or settings.index
    writer = df.write.mode("append").format(settings.index_format)
    if settings.index_format == "es":
        options = settings.index_options()
        if id_column is not None:
            options |= {"es.mapping.id": id_column, "es.mapping.exclude": id_column}
        writer.options(**options).save(index)
    else:
        writer.save(settings.index_path(index))
