"""Occupancy on a live stream of device sightings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.operators.occupancy import (
    DEVICES_PER_PERSON,
    MASK_BITS,
    SLIDE_SECONDS,
    WATERMARK,
    WINDOW_SECONDS,
    approximate_occupancy,
    mask_bits,
    pane_sketches,
    sketched_occupancy,
    sliding_window,
    start_mask,
    window_starts,
    with_people,
)
from roompulse.sinks.stream import BatchFunction


def approximate_windows(
    readings: DataFrame, watermark: str = WATERMARK, window_seconds: int = WINDOW_SECONDS,
    slide_seconds: int = SLIDE_SECONDS, devices_per_person: float = DEVICES_PER_PERSON,
) -> DataFrame:
    """One sketch of fixed size per open window; append or complete mode."""
    return approximate_occupancy(
        readings.withWatermark("timestamp", watermark), window_seconds, slide_seconds, devices_per_person
    )


def sketched_windows(
    readings: DataFrame, watermark: str = WATERMARK, window_seconds: int = WINDOW_SECONDS,
    slide_seconds: int = SLIDE_SECONDS, devices_per_person: float = DEVICES_PER_PERSON,
) -> DataFrame:
    """One sketch per open pane and window, and one update per reading; append mode only."""
    return sketched_occupancy(
        readings.withWatermark("timestamp", watermark), window_seconds, slide_seconds, devices_per_person
    )


def sketch_panes(readings: DataFrame, watermark: str = WATERMARK, pane_seconds: int = SLIDE_SECONDS) -> DataFrame:
    """Closed panes' sketches in append mode, for a table that any window can be read from later."""
    return pane_sketches(readings.withWatermark("timestamp", watermark), pane_seconds)


def exact_windows(
    readings: DataFrame, watermark: str = WATERMARK, window_seconds: int = WINDOW_SECONDS,
    slide_seconds: int = SLIDE_SECONDS, devices_per_person: float = DEVICES_PER_PERSON,
) -> DataFrame:
    """Exact distinct devices in append mode, as two chained aggregations.

    The first keeps one row per (window, device), which spreads a hot window over all tasks, and
    combines a hot device's readings before the shuffle; the second counts the rows of a window, also
    with partial counts first. No set is collected, and the watermark evicts both states.
    """
    seen = device_windows(readings.withWatermark("timestamp", watermark), window_seconds, slide_seconds)
    counts = seen.groupBy("window").agg(F.count("mac").alias("distinct_macs"))
    return with_people(counts, devices_per_person)


def device_windows(
    readings: DataFrame, window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS
) -> DataFrame:
    """One row per window and device. Complete mode keeps all of them for the life of the query."""
    window = sliding_window("timestamp", window_seconds, slide_seconds)
    return readings.groupBy(window, "mac").agg(F.count(F.lit(1)).alias("readings"))


def block_windows(
    readings: DataFrame, watermark: str = WATERMARK, window_seconds: int = WINDOW_SECONDS,
    slide_seconds: int = SLIDE_SECONDS, devices_per_person: float = DEVICES_PER_PERSON,
) -> DataFrame:
    """``exact_windows`` with one state row per device and block of ``MASK_BITS`` window starts; append mode.

    A row has a bit for each window the device was seen in, so a reading doesn't become size/slide state rows; few
    readings lie in two blocks. A window comes out with the last one of its block, and later readings count until then.
    ``newest_windows`` reads it from the state before.
    """
    block = F.window("timestamp", f"{(MASK_BITS - 1) * slide_seconds + window_seconds} seconds", f"{MASK_BITS * slide_seconds} seconds")
    # Block starts are whole numbers of slides since the epoch. A generated row per reading keeps that number apart from
    # the window's struct: Spark can't compile expressions that share a part over the struct.
    before = F.call_function("div", F.unix_micros("block.start"), F.lit(slide_seconds * 1_000_000))
    spans = readings.withWatermark("timestamp", watermark).select("mac", "timestamp", *window_starts("timestamp", window_seconds, slide_seconds))
    blocks = spans.select("mac", "first", "last", block.alias("block")).select("*", F.explode(F.array(before)).alias("before"))
    mask = start_mask(F.col("first") - F.col("before"), F.col("last") - F.col("before"))
    seen = blocks.select("block", "mac", mask.alias("mask")).groupBy("block", "mac").agg(F.bit_or("mask").alias("mask"))
    counts = mask_bits(seen).groupBy("block", "bit").agg(F.count("mac").alias("distinct_macs"))
    return with_people(counts.select(_window_of_bit(window_seconds, slide_seconds), "distinct_macs"), devices_per_person)


def _window_of_bit(window_seconds: int, slide_seconds: int) -> Column:
    start = F.unix_micros("block.start") + F.col("bit").cast("long") * F.lit(slide_seconds * 1_000_000)
    return F.struct(
        F.timestamp_micros(start).alias("start"), F.timestamp_micros(start + F.lit(window_seconds * 1_000_000)).alias("end")
    ).alias("window")


def open_windows(
    spark: SparkSession, checkpoint: str, devices_per_person: float = DEVICES_PER_PERSON,
    window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS,
) -> DataFrame:
    """The windows that ``exact_windows`` or ``block_windows`` hasn't closed yet, read from the state in its checkpoint folder.

    What a window's devices are is in the state of the first aggregation until the watermark passes it, and its
    count in that of the second one after that. The window and slide matter for blocks only.
    """
    counts = None
    for operator in spark.read.format("state-metadata").load(checkpoint).select("operatorId").distinct().collect():
        state = spark.read.format("statestore").option("operatorId", operator[0]).load(checkpoint)
        keys = state.schema["key"].dataType.names
        in_blocks, counted = "block" in keys, "mac" not in keys
        if in_blocks:
            state = state.select("key.*", "value.*")
            if not counted:
                state = mask_bits(state.toDF("block", "mac", "mask"))
            window = _window_of_bit(window_seconds, slide_seconds)
            rows = state.select(window, "count" if counted else "mac")
        else:
            rows = state.select("key.window", "value.count" if counted else "key.mac")
        if counted:
            rows = rows.withColumnRenamed("count", "distinct_macs")
        else:
            rows = rows.groupBy("window").agg(F.count("mac").alias("distinct_macs"))
        counts = rows if counts is None else counts.unionByName(rows)
    # A window can be in both states only between two batches of one run, with parts of its devices in each.
    return with_people(counts.groupBy("window").agg(F.sum("distinct_macs").alias("distinct_macs")), devices_per_person)


def newest_windows(
    spark: SparkSession, checkpoint: str, closed: DataFrame, devices_per_person: float = DEVICES_PER_PERSON,
    window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS,
) -> DataFrame:
    """All windows, newest first: the closed ones of a table, and the open ones of the state.

    The state is bounded by the watermark. A window that was closed after the state was written is the table's.
    """
    open_ = open_windows(spark, checkpoint, devices_per_person, window_seconds, slide_seconds)
    open_ = open_.join(closed.select("start"), "start", "left_anti")
    return closed.select(open_.columns).unionByName(open_).orderBy(F.col("start").desc())


def newest_first_table(path: str, devices_per_person: float = DEVICES_PER_PERSON) -> BatchFunction:
    """A complete-mode batch of ``device_windows`` as a table of windows, sorted newest first.

    Each batch writes its own folder; the caller reads the newest one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("window").agg(F.count("mac").alias("distinct_macs"))
        table = with_people(counts, devices_per_person).orderBy(F.col("start").desc())
        table.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
