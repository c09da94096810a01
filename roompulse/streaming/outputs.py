"""Outputs of per-batch callbacks, and fan-out to several of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from roompulse.config import Settings
from roompulse.functions.ingest import as_bytes, to_json_value
from roompulse.schemas import DOCUMENT_ID
from roompulse.sinks.batch import write_index, write_topic
from roompulse.sources.index import OWN_BATCH_ID
from roompulse.sinks.stream import BatchFunction, batch_folder, write_batch


def fan_out(outputs: Sequence[BatchFunction], kept: bool = False) -> BatchFunction:
    """One pass over the source for several outputs: each micro-batch is computed once.

    A batch is held for that, unless there is one output only or the caller holds what the batch is made from (``kept``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        hold = len(outputs) > 1 and not kept
        if hold:
            batch.persist()
        try:
            for output in outputs:
                output(batch, batch_id)
        finally:
            if hold:
                batch.unpersist()

    return write


def table_output(path: str, file_format: str = "parquet") -> BatchFunction:
    """A fan-out branch that writes the batch to its own folder of a table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id, file_format)

    return write


def console_output(rows: int = 20) -> BatchFunction:
    """A fan-out branch that shows the first rows of the batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(rows, truncate=False)

    return write


def csv_output(path: str) -> BatchFunction:
    """A fan-out branch into quoted CSV files with headers; a replayed batch replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("header", True).option("escape", '"').csv(batch_folder(path, batch_id))

    return write


def index_output(settings: Settings, index: str | None = None) -> BatchFunction:
    """A fan-out branch into an index; a replayed batch replaces what it wrote before.

    In a search index that takes rows with a document id; files are replaced per batch.
    """
    index = index or settings.index

    def write(batch: DataFrame, batch_id: int) -> None:
        if settings.index_format == "es":
            id_column = DOCUMENT_ID if DOCUMENT_ID in batch.columns else None
            write_index(batch, settings, index, id_column)
        else:
            rows = batch.drop(DOCUMENT_ID).withColumnRenamed("batch_id", OWN_BATCH_ID)
            write_batch(rows, settings.index_path(index), batch_id, settings.index_format)

    return write


def topic_output(settings: Settings, topic: str, whole: bool = False) -> BatchFunction:
    """A fan-out branch into a topic; a message bus takes a replayed batch twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if settings.stream_format == "kafka":
            write_topic(batch, settings, topic, whole)
        else:
            values = as_bytes(batch if whole else to_json_value(batch))
            write_batch(values, settings.topic_path(topic), batch_id, settings.stream_format)

    return write
