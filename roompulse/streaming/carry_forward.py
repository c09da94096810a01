"""Carry-forward merge on a stream: each micro-batch is filled by windows, and one row per device is carried to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roompulse.sinks.stream import BatchFunction, batch_folder, committed_batches, drop_batches

COMPACT_EVERY = 20


class KnownValues:
    """The newest known value of every column per key, as a table of what each micro-batch added.

    Batch n writes its own folder below ``changes``, so a replay replaces it, and reads only folders of earlier batches: the
    latest one below ``whole``, which has everything up to its batch, and the changes after it. Every ``every`` batches the
    whole is written anew and older folders go. With ``idle`` (``30 days``) a key that no batch has brought for so long is left out then.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = COMPACT_EVERY, idle: str | None = None):
        self.spark, self.path, self.every, self.idle = spark, path, every, idle

    def before(self, batch_id: int) -> DataFrame | None:
        whole = [b for b in committed_batches(self.spark, f"{self.path}/whole") if b < batch_id]
        first = whole[-1] if whole else -1
        paths = [batch_folder(f"{self.path}/whole", first)] if whole else []
        changes = committed_batches(self.spark, f"{self.path}/changes")
        paths += [batch_folder(f"{self.path}/changes", b) for b in changes if first < b < batch_id]
        if not paths:
            return None
        rows = self.spark.read.parquet(*paths)
        return newest(rows, [c for c in rows.columns if c not in ("_key", "_seen")])

    def add(self, changes: DataFrame, batch_id: int) -> None:
        changes.write.mode("overwrite").parquet(batch_folder(f"{self.path}/changes", batch_id))
        if (batch_id + 1) % self.every:
            return
        whole = self.before(batch_id + 1)
        if self.idle is not None:
            whole = whole.filter(F.col("_seen") >= F.current_timestamp() - F.expr(f"INTERVAL {self.idle}"))
        whole.write.mode("overwrite").parquet(batch_folder(f"{self.path}/whole", batch_id))
        # A replay of this batch still reads what was there before it.
        kept = max([b for b in committed_batches(self.spark, f"{self.path}/whole") if b < batch_id], default=None)
        if kept is not None:
            drop_batches(self.spark, f"{self.path}/changes", kept + 1)
            drop_batches(self.spark, f"{self.path}/whole", kept)


def newest(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per key the entry of the greatest position of every column, combined before the shuffle."""
    return rows.groupBy("_key").agg(*(F.max(c).alias(c) for c in columns), F.max("_seen").alias("_seen"))


def carry_forward_batches(
    output: BatchFunction, known: KnownValues, key: str, order: Sequence[str], columns: Sequence[str], segment: Column | None = None,
) -> BatchFunction:
    """Fill NULLs in ``columns`` with the last non-NULL value of the same key, across micro-batches, and hand the rows on.

    A row takes the latest value at or before its own position in ``order`` among its micro-batch and the newest one of earlier
    batches; so the borders of batches don't matter to rows in order, and a late row never sees a value from after it. NULLs in
    ``order`` stand before all other values. ``segment``, which must not decrease along ``order``, cuts a key with a large share of
    the rows into many tasks, as in ``operators.carry_forward``; what is known before a segment is one row per key and segment, and
    earlier batches come in through these rows. A window holds its rows on disk where memory doesn't do.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            place = F.struct(*order)
            entries = {f"_entry{i}": F.when(F.col(f"`{c}`").isNotNull(), F.struct(place.alias("at"), F.col(f"`{c}`").alias("value")))
                       for i, c in enumerate(columns)}
            # Structs group and join NULLs like any other value.
            rows = batch.withColumns({
                "_key": F.struct(key), "_segment": F.struct((F.lit(0) if segment is None else segment).alias("s")), **entries})
            running = Window.partitionBy("_key", "_segment").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
            filled = rows.withColumns({f"{e}_here": F.last(e, ignorenulls=True).over(running) for e in entries})
            parts = rows.groupBy("_key", "_segment").agg(*(F.max(e).alias(e) for e in entries))
            before = Window.partitionBy("_key").orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
            carried = parts.select("_key", "_segment", *(F.last(e, ignorenulls=True).over(before).alias(f"{e}_before") for e in entries))
            earlier = known.before(batch_id)
            if earlier is None:
                carried = carried.withColumns({f"{e}_known": F.lit(None).cast(rows.schema[e].dataType) for e in entries})
            else:
                carried = carried.join(
                    earlier.select("_key", *(F.col(e).alias(f"{e}_known") for e in entries)), "_key", "left")
            joined = filled.join(carried, ["_key", "_segment"], "left")

            def value(entry: str) -> Column:
                own = F.coalesce(f"{entry}_here", f"{entry}_before")
                old = F.when(F.col(f"{entry}_known.at") <= place, F.col(f"{entry}_known"))
                later = old.isNotNull() & (own.isNull() | (own["at"] < old["at"]))
                return F.when(later, old["value"]).otherwise(own["value"])

            of = dict(zip(columns, entries, strict=True))
            output(joined.select(*(value(of[c]).alias(c) if c in of else F.col(f"`{c}`") for c in batch.columns)), batch_id)
            changes = rows.withColumn("_seen", F.current_timestamp())
            known.add(newest(changes, list(entries)), batch_id)
        finally:
            batch.unpersist()

    return write
