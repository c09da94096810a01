"""Occupancy against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from roompulse.operators.occupancy import (
    approximate_occupancy, exact_occupancy, latest_windows, sketched_occupancy,
)


def brute_force(rows, size, slide):
    """Windows as {start micros: set of devices}."""
    windows = {}
    size_us, slide_us = round(size * 1e6), round(slide * 1e6)
    for mac, micros in rows:
        if micros is None:
            continue
        start = micros // slide_us * slide_us
        while start > micros - size_us:
            windows.setdefault(start, set()).add(mac)
            start -= slide_us
    return {start: len(macs - {None}) for start, macs in windows.items()}


def result(df):
    rows = df.select(F.unix_micros("start"), F.unix_micros("end"), "distinct_macs", "approx_people").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


def frame(spark, rows):
    df = spark.createDataFrame(rows, "mac string, micros long")
    return df.select("mac", F.timestamp_micros("micros").alias("timestamp"))


def sample(count, span_seconds, origin=1_704_067_200_000_000, seed=7):
    """A third of the readings from one device; some without device or time; some on window limits."""
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        mac = "hot" if rng.random() < 0.33 else f"m{rng.randrange(40)}"
        micros = origin + rng.randrange(span_seconds * 1_000_000)
        if rng.random() < 0.2:
            micros = micros // 30_000_000 * 30_000_000
        rows.append((mac if rng.random() > 0.02 else None, micros if rng.random() > 0.02 else None))
    return rows


@pytest.mark.parametrize(
    ("size", "slide"), [(120, 30), (30, 30), (100, 30), (7, 3), (3600, 10), (20, 60)]
)
def test_exact_equals_brute_force(spark, size, slide):
    rows = sample(800, 7200)
    expected = brute_force(rows, size, slide)
    got = result(exact_occupancy(frame(spark, rows), size, slide))
    assert {start: values[1] for start, values in got.items()} == expected
    for start, (end, n, people) in got.items():
        assert end - start == size * 1_000_000
        assert people == n / 3


def test_exact_before_1970(spark):
    rows = sample(300, 3600, origin=-90_000_000_000)
    got = result(exact_occupancy(frame(spark, rows)))
    assert {start: values[1] for start, values in got.items()} == brute_force(rows, 120, 30)


def test_window_of_unknown_devices_counts_zero(spark):
    got = result(exact_occupancy(frame(spark, [(None, 0)])))
    assert [v[1] for v in got.values()] == [0, 0, 0, 0]


def test_exact_and_spark_windows_agree(spark):
    rows = sample(1000, 3600)
    exact = result(exact_occupancy(frame(spark, rows)))
    approx = result(approximate_occupancy(frame(spark, rows)))
    assert set(exact) == set(approx)
    assert all(abs(exact[s][1] - approx[s][1]) <= max(2, 0.2 * exact[s][1]) for s in exact)


def test_people_per_device(spark):
    got = result(exact_occupancy(frame(spark, [("a", 0), ("b", 0)]), devices_per_person=2))
    assert {v[2] for v in got.values()} == {1.0}


def test_latest_windows(spark):
    rows = [("a", s * 1_000_000) for s in range(0, 600, 10)]
    newest = latest_windows(exact_occupancy(frame(spark, rows)), 3)
    starts = [r[0] for r in newest.select(F.unix_seconds("start")).collect()]
    assert starts == [570, 540, 510]


def test_no_window_gathers_its_rows(spark):
    """Both shuffles come after a partial aggregate, and none is on the window alone before it."""
    plan = exact_occupancy(frame(spark, sample(50, 600)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 2
    assert "partial_bit_or" in plan and "partial_count" in plan


def test_merged_sketches(spark):
    rows = sample(1000, 3600)
    exact = result(exact_occupancy(frame(spark, rows)))
    merged = result(sketched_occupancy(frame(spark, rows)))
    assert set(exact) == set(merged)
    assert all(abs(exact[s][1] - merged[s][1]) <= max(1, 0.05 * exact[s][1]) for s in exact)
    with pytest.raises(ValueError, match="multiple"):
        sketched_occupancy(frame(spark, rows), 100, 30)
