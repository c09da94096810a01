"""Late rows kept: what a watermark would drop goes to a table of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roompulse.operators.occupancy import WATERMARK
from roompulse.sinks.stream import BatchFunction, batch_folder, committed_batches, drop_batches


def split_late(on_time: BatchFunction, late: BatchFunction, path: str, time: str = "timestamp", delay: str = WATERMARK) -> BatchFunction:
    """Hand each micro-batch on in two parts: rows on time, and rows from before the watermark, with the watermark.

    The watermark is that of a stateful operator: ``delay`` behind the greatest time of all earlier batches, and the same
    for a whole batch. It is kept per batch below ``path``, so a replayed batch is split the same way. Rows without a time, which
    windows leave out, go with the late ones. A stream over the rows on time never drops one: its own watermark, which sees
    them later, is at most as far.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [b for b in committed_batches(spark, path) if b < batch_id]
        newest = spark.read.parquet(batch_folder(path, earlier[-1])).first()["newest"] if earlier else None
        watermark = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        batch.persist()
        try:
            is_late = F.col(time).isNull() | F.coalesce(F.col(time) < watermark, F.lit(False))
            on_time(batch.filter(~is_late), batch_id)
            late(batch.filter(is_late).withColumn("watermark", watermark), batch_id)
            latest = F.greatest(F.max(time), F.lit(newest).cast("timestamp"))
            batch.agg(latest.alias("newest")).write.mode("overwrite").parquet(batch_folder(path, batch_id))
        finally:
            batch.unpersist()
        if earlier:
            drop_batches(spark, path, earlier[-1])

    return write
