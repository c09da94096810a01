"""Label a live stream of readings for training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roompulse.functions.ingest import message_text, parse_messages
from roompulse.functions.rules import comfort_label, is_number
from roompulse.operators.comfort_model import complete_and_rejected
from roompulse.schemas import ROOM_READING, SENSOR_COLUMNS
from roompulse.sinks.stream import BatchFunction


def labelled_readings(lines: DataFrame, value: str = "value") -> DataFrame:
    """JSON readings with all three sensor values, as training rows."""
    complete, _ = complete_and_rejected(parse_messages(lines, ROOM_READING, value))
    return complete.select(*SENSOR_COLUMNS, comfort_label().alias("comfortable"))


def rejected_readings(lines: DataFrame, value: str = "value") -> DataFrame:
    """The lines that ``labelled_readings`` leaves out, as they came."""
    parsed = lines.select(message_text(value).alias("value"), F.from_json(message_text(value), ROOM_READING).alias("reading"))
    whole = F.lit(True)
    for name in SENSOR_COLUMNS:
        whole = whole & is_number(f"reading.{name}")
    return parsed.filter(~F.coalesce(whole, F.lit(False))).select("value")


def label_batches(labelled: BatchFunction, rejected: BatchFunction) -> BatchFunction:
    """Both sides of each micro-batch of lines to their outputs."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            labelled(labelled_readings(batch), batch_id)
            rejected(rejected_readings(batch), batch_id)
        finally:
            batch.unpersist()

    return write
