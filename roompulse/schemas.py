"""Declared schemas of every table and message."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


ROOM_READING = _struct(
    mac=T.StringType(),
    rssi=T.IntegerType(),
    temperature=T.DoubleType(),
    humidity=T.DoubleType(),
    light=T.DoubleType(),
    timestamp=T.DoubleType(),
)

ENVIRONMENT_READING = _struct(
    light=T.DoubleType(),
    temperature=T.DoubleType(),
    humidity=T.DoubleType(),
    timestamp=T.DoubleType(),
)

DEVICE_SIGHTING = _struct(
    mac=T.StringType(),
    rssi=T.IntegerType(),
    timestamp=T.DoubleType(),
)

TRAINING_ROW = _struct(
    light=T.DoubleType(),
    temperature=T.DoubleType(),
    humidity=T.DoubleType(),
    comfortable=T.IntegerType(),
)

# The columns a message bus source delivers.
ENVELOPE = _struct(
    key=T.BinaryType(),
    value=T.BinaryType(),
    topic=T.StringType(),
    partition=T.IntegerType(),
    offset=T.LongType(),
    timestamp=T.TimestampType(),
    timestampType=T.IntegerType(),
)

SENSOR_COLUMNS = ["light", "temperature", "humidity"]
DEVICE_COLUMNS = ["mac", "rssi"]
SCORED_COLUMNS = [
    "mac", "rssi", "temperature", "humidity", "light", "prediction", "prediction_str", "timestamp",
]

# A message's place in its topic, as the id of the document it becomes.
DOCUMENT_ID = "document_id"
