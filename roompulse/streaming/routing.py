"""One mixed stream to two tables or topics in one pass over the source."""

from __future__ import annotations

from pyspark.sql import DataFrame

from roompulse.functions.ingest import stamped_records
from roompulse.operators.routing import device_route, environment_route
from roompulse.schemas import DEVICE_COLUMNS, SENSOR_COLUMNS
from roompulse.sinks.stream import BatchFunction


def route_records(environment: BatchFunction, devices: BatchFunction) -> BatchFunction:
    """Hand each micro-batch of JSON lines on as whole stamped records, less the keys of the other route."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            environment(stamped_records(batch, without=tuple(DEVICE_COLUMNS)), batch_id)
            devices(stamped_records(batch, without=tuple(SENSOR_COLUMNS)), batch_id)
        finally:
            batch.unpersist()

    return write


def route_batches(environment: BatchFunction, devices: BatchFunction) -> BatchFunction:
    """Hand the two projections of each micro-batch to their outputs."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            environment(environment_route(batch), batch_id)
            devices(device_route(batch), batch_id)
        finally:
            batch.unpersist()

    return write
