"""Room occupancy: distinct devices per sliding window and the people they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Window, slide, watermark and devices per person.
WINDOW_SECONDS = 120
SLIDE_SECONDS = 30
WATERMARK = "1 minute"
DEVICES_PER_PERSON = 3

# Window starts per bit mask; a LONG holds them without using the sign bit.
MASK_BITS = 60


def sliding_window(
    timestamp: str = "timestamp", window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS
) -> Column:
    return F.window(timestamp, f"{window_seconds} seconds", f"{slide_seconds} seconds")


def with_people(counts: DataFrame, devices_per_person: float = DEVICES_PER_PERSON) -> DataFrame:
    """Flatten the window and add ``approx_people``."""
    return counts.select(
        F.col("window.start").alias("start"),
        F.col("window.end").alias("end"),
        "distinct_macs",
        (F.col("distinct_macs") / devices_per_person).alias("approx_people"),
    )


def approximate_occupancy(
    readings: DataFrame,
    window_seconds: int = WINDOW_SECONDS,
    slide_seconds: int = SLIDE_SECONDS,
    devices_per_person: float = DEVICES_PER_PERSON,
) -> DataFrame:
    """Sketch-based distinct devices per window (5 % relative error), batch or streaming.

    One shuffle: each task sends one fixed-size sketch per window it saw, however hot the window.
    """
    counts = readings.groupBy(sliding_window("timestamp", window_seconds, slide_seconds)).agg(
        F.approx_count_distinct("mac").alias("distinct_macs")
    )
    return with_people(counts, devices_per_person)


def sketched_occupancy(
    readings: DataFrame,
    window_seconds: int = WINDOW_SECONDS,
    slide_seconds: int = SLIDE_SECONDS,
    devices_per_person: float = DEVICES_PER_PERSON,
) -> DataFrame:
    """Sketch-based distinct devices with one sketch update per reading, batch or append mode.

    A sketch per slide-long pane comes first, then the sketches of a window's panes are merged, so
    readings are not multiplied by size/slide. On a stream a reading that is later than the watermark
    allows is lost as soon as its pane is closed, and not window by window. The window's size must be
    a multiple of the slide.
    """
    if window_seconds % slide_seconds:
        raise ValueError("the window must be a multiple of the slide")
    pane = F.window("timestamp", f"{slide_seconds} seconds").alias("pane")
    panes = readings.groupBy(pane).agg(F.hll_sketch_agg("mac").alias("sketch"))
    merged = panes.groupBy(
        sliding_window("pane", window_seconds, slide_seconds).alias("window")
    ).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_macs"))
    return with_people(merged, devices_per_person)


def pane_sketches(readings: DataFrame, pane_seconds: int = SLIDE_SECONDS, log_size: int = 12) -> DataFrame:
    """One mergeable sketch of the devices per pane: its start and end, and the sketch. Batch or append mode."""
    panes = readings.groupBy(F.window("timestamp", f"{pane_seconds} seconds").alias("pane")).agg(
        F.hll_sketch_agg("mac", F.lit(log_size)).alias("sketch"))
    return panes.select(F.col("pane.start").alias("pane_start"), F.col("pane.end").alias("pane_end"), "sketch")


def occupancy_from_panes(
    panes: DataFrame, window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS,
    devices_per_person: float = DEVICES_PER_PERSON, pane_seconds: int = SLIDE_SECONDS,
) -> DataFrame:
    """Any windows from kept pane sketches, without the readings: sizes and slides are multiples of the pane's.

    Readings move no more; a window costs one sketch per pane, and each task sends one sketch per window.
    """
    if window_seconds % pane_seconds or slide_seconds % pane_seconds:
        raise ValueError("the window and the slide must be multiples of the pane")
    window = F.window("pane_start", f"{window_seconds} seconds", f"{slide_seconds} seconds").alias("window")
    merged = panes.groupBy(window).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_macs"))
    return with_people(merged, devices_per_person)


def _floor_div(value: Column, step: int) -> Column:
    """Exact integer floor division, also for times before 1970."""
    return F.call_function("div", value - F.pmod(value, F.lit(step)), F.lit(step))


def start_mask(first: Column, last: Column) -> Column:
    """A LONG with the bits from ``first`` to ``last`` set, those of them that are below ``MASK_BITS``."""
    from_first = F.call_function("shiftleft", F.lit(-1).cast("long"), F.greatest(first, F.lit(0)).cast("int"))
    to_last = F.call_function(
        "shiftright", F.lit((1 << MASK_BITS) - 1), (F.lit(MASK_BITS - 1) - F.least(last, F.lit(MASK_BITS - 1))).cast("int"))
    return from_first.bitwiseAND(to_last)


def mask_bits(masks: DataFrame) -> DataFrame:
    """One row per set bit of the column ``mask``, its number in ``bit``."""
    one = F.lit(1).cast("long")
    is_set = F.call_function("shiftright", F.col("mask"), F.col("bit")).bitwiseAND(one) == 1
    # From a mask's lowest set bit to its highest one.
    lowest = F.bit_count(F.col("mask").bitwiseAND(-F.col("mask")) - one)
    highest = F.length(F.bin("mask")) - 1
    return masks.select("*", F.explode(F.sequence(lowest, highest)).alias("bit")).filter(is_set).drop("mask")


def window_starts(timestamp: str, window_seconds: int, slide_seconds: int) -> list[Column]:
    """The ``first`` and ``last`` window that hold a time, counted in slides since the epoch."""
    slide, size = slide_seconds * 1_000_000, window_seconds * 1_000_000
    return [
        (_floor_div(F.unix_micros(timestamp) - size, slide) + 1).alias("first"),
        _floor_div(F.unix_micros(timestamp), slide).alias("last"),
    ]


def exact_occupancy(
    readings: DataFrame,
    window_seconds: int = WINDOW_SECONDS,
    slide_seconds: int = SLIDE_SECONDS,
    devices_per_person: float = DEVICES_PER_PERSON,
) -> DataFrame:
    """Exact distinct devices per window for bounded input.

    Expanding every reading to its windows would multiply the rows by size/slide before the
    shuffle. Here a reading becomes a bit mask of the window starts it falls into, 60 starts to a
    LONG. Masks are OR-ed per (device, mask number) before and after the one wide shuffle, so a
    task sends one row per device and half hour, and neither a hot device nor a hot window gathers
    its readings in one place. The set bits are then counted per window, with partial counts first.
    """
    spans = readings.filter(F.col("timestamp").isNotNull()).select(
        "mac", *window_starts("timestamp", window_seconds, slide_seconds))
    words = spans.select(
        "mac", "first", "last",
        F.explode(
            F.sequence(_floor_div(F.col("first"), MASK_BITS), _floor_div(F.col("last"), MASK_BITS))
        ).alias("word"),
    )
    before = F.col("word") * MASK_BITS
    mask = start_mask(F.col("first") - before, F.col("last") - before)
    seen = words.select("mac", "word", mask.alias("mask")).groupBy("mac", "word").agg(
        F.bit_or("mask").alias("mask")
    )
    counts = mask_bits(seen).groupBy("word", "bit").agg(F.count("mac").alias("distinct_macs"))
    start = (F.col("word") * MASK_BITS + F.col("bit")) * slide_seconds
    window = F.struct(
        F.timestamp_seconds(start).alias("start"),
        F.timestamp_seconds(start + window_seconds).alias("end"),
    )
    return with_people(
        counts.select(window.alias("window"), "distinct_macs"), devices_per_person
    )


def latest_windows(occupancy: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` windows, newest first; each task keeps only its own newest ``n``."""
    return occupancy.orderBy(F.col("start").desc()).limit(n)
