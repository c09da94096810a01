"""Live comfort scores: parse, set incomplete readings apart, score."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roompulse.functions.ingest import parse_readings
from roompulse.functions.rules import is_number
from roompulse.functions.scoring import LinearModel, with_score
from roompulse.operators.comfort_model import complete_and_rejected, score, with_prediction_text
from roompulse.schemas import DOCUMENT_ID, ROOM_READING, SCORED_COLUMNS
from roompulse.sinks.stream import BatchFunction


def score_readings(readings: DataFrame, model: PipelineModel | LinearModel, strict: bool = False) -> DataFrame:
    """The output columns of the live job. Narrow: no shuffle, no state.

    A fitted pipeline fails on a missing feature; ``strict`` makes plain weights do so too.
    """
    if isinstance(model, LinearModel) and strict:
        missing = ~reduce(and_, map(is_number, model.features))
        stop = F.raise_error(F.lit("a reading lacks a feature")).cast("double")
        first = model.features[0]
        readings = readings.withColumn(first, F.when(missing, stop).otherwise(F.col(first)))
    scored = with_score(readings, model) if isinstance(model, LinearModel) else score(readings, model)
    kept = [DOCUMENT_ID] if DOCUMENT_ID in readings.columns else []
    return with_prediction_text(scored).select(*kept, *SCORED_COLUMNS)


def score_messages(
    messages: DataFrame, model: PipelineModel | LinearModel, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Scored readings, and the readings with a missing feature.

    ``strict`` scores every reading, so a missing feature stops the job.
    """
    readings = parse_readings(messages, ROOM_READING)
    complete, rejected = complete_and_rejected(readings)
    return score_readings(readings if strict else complete, model, strict), rejected


def score_batches(
    model: PipelineModel | LinearModel, scored: BatchFunction, rejected: BatchFunction,
    strict: bool = False,
) -> BatchFunction:
    """Score each micro-batch of readings and hand on both parts; the batch is parsed once.

    ``strict`` scores every reading, as in ``score_messages``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            complete, incomplete = complete_and_rejected(batch)
            scored(score_readings(batch if strict else complete, model, strict), batch_id)
            if not strict:
                rejected(incomplete, batch_id)
        finally:
            batch.unpersist()

    return write
