"""Split one mixed feed by columns; each reading appears in both outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from roompulse.schemas import DEVICE_COLUMNS, SENSOR_COLUMNS


def environment_route(readings: DataFrame) -> DataFrame:
    """Without the device columns."""
    return readings.drop(*DEVICE_COLUMNS)


def device_route(readings: DataFrame) -> DataFrame:
    """Without the sensor columns."""
    return readings.drop(*SENSOR_COLUMNS)
