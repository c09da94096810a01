"""Carry-forward merge: each row shows the last known value of every column for its device."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carry_forward(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    columns: Sequence[str],
    segment: Column | None = None,
) -> DataFrame:
    """Fill NULLs in ``columns`` with the last non-NULL value of the same key in ``order``.

    ``order`` must be unique within a key. Whole rows are shuffled once, on (key, segment), and filled by a
    running window. ``segment``, which must not decrease along ``order``, cuts a key with a large share of the
    rows into many tasks: a day or an hour of its time. What earlier segments know of a key is one row per
    key and segment, combined before its own small shuffle, and joined without moving the whole rows again.
    Without a segment a key is one task, which spills when it has to.
    """
    # A struct groups and joins NULL keys like any other.
    rows = df.withColumns({"_key": F.struct(key), "_segment": F.lit(0) if segment is None else segment})
    within = Window.partitionBy("_key", "_segment").orderBy(*order)
    running = within.rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.withColumns({name: F.last(name, ignorenulls=True).over(running) for name in columns})
    if segment is None:
        return filled.select(*df.columns)
    known = last_values(rows, ["_key", "_segment"], order, columns)
    before = Window.partitionBy("_key").orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = known.select(
        "_key", "_segment",
        *[F.last(name, ignorenulls=True).over(before).alias(f"_carried_{name}") for name in columns],
    )
    joined = filled.join(carried, ["_key", "_segment"], "left")
    return joined.select(
        *[F.coalesce(name, f"_carried_{name}").alias(name) if name in columns else F.col(name) for name in df.columns]
    )


def last_values(
    df: DataFrame, key: str | Sequence[str], order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The last known value of every column per key: one row per key, combined before the shuffle."""
    position = F.struct(*order)
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(
        *[
            F.max_by(F.col(name), F.when(F.col(name).isNotNull(), position)).alias(name)
            for name in columns
        ]
    )
