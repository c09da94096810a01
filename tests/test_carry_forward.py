"""Carry-forward with and without segments against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from roompulse.operators.carry_forward import carry_forward, last_values
from roompulse.streaming.carry_forward import KnownValues, carry_forward_batches

COLUMNS = ["light", "rssi"]
SCHEMA = "id long, device string, t long, light double, rssi int"


def feed(count=2000, seed=3):
    """Half of the rows from one device, one device without values, one unknown device."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        device = rng.choice(["hot"] * 6 + ["a", "b", "silent", None, "c", "d"])
        light = rng.random() if rng.random() < 0.05 and device != "silent" else None
        rssi = -rng.randrange(90) if rng.random() < 0.3 and device != "silent" else None
        rows.append((i, device, rng.randrange(300), light, rssi))
    return rows


def loop(rows):
    known, out = {}, {}
    for i, device, t, light, rssi in sorted(rows, key=lambda r: (r[2], r[0])):
        old = known.get(device, (None, None))
        known[device] = (light if light is not None else old[0], rssi if rssi is not None else old[1])
        out[i] = known[device]
    return out, known


def filled(df):
    return {r["id"]: (r["light"], r["rssi"]) for r in df.collect()}


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(feed(), SCHEMA).repartition(5).cache()


@pytest.mark.parametrize("length", [None, 1, 7, 100, 1000])
def test_segments_do_not_change_the_rows(df, length):
    segment = None if length is None else F.floor(F.col("t") / length)
    got = carry_forward(df, "device", ["t", "id"], COLUMNS, segment)
    assert got.columns == df.columns and got.count() == 2000
    assert filled(got) == loop(feed())[0]


def test_whole_rows_are_shuffled_once(spark, tmp_path):
    spark.createDataFrame(feed(), SCHEMA).withColumn("payload", F.lit("wide")).write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in")
    got = carry_forward(rows, "device", ["t", "id"], COLUMNS, F.floor(F.col("t") / 10))
    plan = got._jdf.queryExecution().executedPlan().toString()
    exchanges = plan.split("Exchange hashpartitioning")[1:]
    wide = [part for part in exchanges if "payload" in part.split("Exchange")[0].split("FileScan")[0]]
    assert len(wide) == 1


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert carry_forward(empty, "device", ["t", "id"], COLUMNS).count() == 0


def test_last_values(df):
    got = {r["device"]: (r["light"], r["rssi"]) for r in last_values(df, "device", ["t", "id"], COLUMNS).collect()}
    assert got == loop(feed())[1]


class Collected(dict):
    """An output that keeps the filled rows of each batch; a replayed batch replaces its own."""

    def __call__(self, batch, batch_id):
        self[batch_id] = {r["id"]: (r["light"], r["rssi"]) for r in batch.collect()}


def loop_of_batches(batches):
    """Row by row: the latest value at or before a row, of its batch or the newest one of earlier batches. None stands first."""
    place = lambda r: (r[2] is not None, r[2] or 0, r[0])
    state, out = {}, {}
    for rows in batches:
        for i, device, t, *_ in rows:
            found = []
            for c in (3, 4):
                own = [(place(r), r[c]) for r in rows if r[1] == device and r[c] is not None and place(r) <= place((i, device, t))]
                old = state.get((device, c))
                if old and old[0] <= place((i, device, t)):
                    own.append(old)
                found.append(max(own)[1] if own else None)
            out[i] = tuple(found)
        for r in rows:
            for c in (3, 4):
                if r[c] is not None and (state.get((r[1], c)) is None or state[r[1], c][0] < place(r)):
                    state[r[1], c] = (place(r), r[c])
    return out


@pytest.mark.parametrize(("length", "every"), [(None, 20), (7, 2), (50, 1)])
def test_batches_against_a_plain_loop(spark, tmp_path, length, every):
    """Late rows, rows without a time, a hot device, replays, and compactions between batches."""
    rows = [(i, d, None if i % 37 == 5 else t, light, rssi) for i, d, t, light, rssi in feed(600, seed=8)]
    batches = [rows[a:a + 120] for a in range(0, 600, 120)]
    segment = None if length is None else F.floor(F.col("t") / length)
    out, known = Collected(), KnownValues(spark, f"{tmp_path}/known", every)
    fill = carry_forward_batches(out, known, "device", ["t", "id"], COLUMNS, segment)
    for n, part in enumerate(batches):
        for _ in range(2 if n in (1, 3) else 1):
            fill(spark.createDataFrame(part, SCHEMA).repartition(3), n)
    assert {i: v for batch in out.values() for i, v in batch.items()} == loop_of_batches(batches)


def test_a_batch_without_times_and_idle_devices(spark, tmp_path):
    out, known = Collected(), KnownValues(spark, f"{tmp_path}/known", every=2, idle="0 seconds")
    fill = carry_forward_batches(out, known, "device", ["t", "id"], COLUMNS)
    fill(spark.createDataFrame([(1, "a", None, 1.0, None), (2, "a", None, None, -3)], SCHEMA), 0)
    fill(spark.createDataFrame([(3, "a", None, None, None), (4, None, 5, None, None)], SCHEMA), 1)
    fill(spark.createDataFrame([(5, "a", 9, None, None)], SCHEMA), 2)
    fill(spark.createDataFrame([], SCHEMA), 3)
    # The second batch forgot every device that is silent for no time at all.
    assert out == {0: {1: (1.0, None), 2: (1.0, -3)}, 1: {3: (1.0, -3), 4: (None, None)}, 2: {5: (None, None)}, 3: {}}
