"""What streams leave behind as tables: open windows, pane sketches, late rows, events of a watch; and the rank area."""

import json
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from roompulse.operators.evaluation import rank_area
from roompulse.operators.occupancy import exact_occupancy, occupancy_from_panes, pane_sketches
from roompulse.plans import stream as plans
from roompulse.sinks.stream import checkpoint_folder, committed_batches, drain, to_batches, to_files
from roompulse.streaming.late import split_late
from roompulse.streaming.occupancy import block_windows, exact_windows, newest_windows, open_windows, sketch_panes
from roompulse.streaming.outputs import table_output
from roompulse.streaming.watch import StreamWatch, lost_messages, watched_events
from test_streaming import deliver, sightings, windows


def test_open_and_closed_windows_are_all_windows(spark, tmp_path):
    everything = []
    for rows in ([("a", 0.0), ("b", 10.0), ("a", 45.0)], [("a", 290.0), ("c", 300.0)], [("d", 301.0), ("d", 900.0)]):
        everything += rows
        stream = deliver(spark, rows, f"{tmp_path}/in")
        drain(to_files(exact_windows(stream), "q", f"{tmp_path}/cp", f"{tmp_path}/out"), spark)
        closed = spark.read.schema("start timestamp, end timestamp, distinct_macs long, approx_people double").parquet(f"{tmp_path}/out")
        checkpoint = checkpoint_folder(f"{tmp_path}/cp", "q")
        found = newest_windows(spark, checkpoint, closed)
        assert windows(found) == windows(exact_occupancy(sightings(spark, everything)))
        starts = [r["start"] for r in found.collect()]
        assert starts == sorted(starts, reverse=True)
        newest = max(s for _, s in everything)
        # The state holds what the watermark hasn't passed, and nothing else.
        assert all(start + 120 > newest - 60 for start in windows(open_windows(spark, checkpoint)))


@pytest.mark.parametrize("size, slide", [(120, 30), (600, 60), (100, 30), (4000, 40)])
def test_blocks_give_all_windows_from_a_state_row_per_device_and_block(spark, tmp_path, size, slide):
    draw = random.Random(size)
    everything, block = [], 60 * slide
    for k in range(3):
        rows = [(draw.choice("abc"), k * block + draw.uniform(-block, block)) for _ in range(60)]
        rows += [("a", float(k * block)), (None, k * block - 0.000001), ("b", k * block + slide * 59.0), ("c", None)]
        # No reading is late, and none is before 1970, where a stream's first watermark stands.
        rows = [(m, None if t is None else t + (2 * k + 200) * block) for m, t in rows]
        everything += rows
        stream = deliver(spark, rows, f"{tmp_path}/in")
        query = drain(to_files(block_windows(stream, "1 hour", size, slide), "q", f"{tmp_path}/cp", f"{tmp_path}/out"), spark)
        seen = query.recentProgress[0].stateOperators[-1].numRowsUpdated
        timed = {(m, t // block) for m, t in rows if t is not None}
        assert seen <= len(timed) * (2 + size // block) <= 4 * 4 * (2 + size // block)
        closed = spark.read.schema("start timestamp, end timestamp, distinct_macs long, approx_people double").parquet(f"{tmp_path}/out")
        found = newest_windows(spark, checkpoint_folder(f"{tmp_path}/cp", "q"), closed, window_seconds=size, slide_seconds=slide)
        assert windows(found) == windows(exact_occupancy(sightings(spark, everything), size, slide))
        assert found.count() == len(windows(found))
    assert closed.count()


def test_newest_windows_hold_few_state_rows(spark, tmp_path, monkeypatch):
    """A reading was a state row in each of its four windows."""
    updated = []

    def noted(*args):
        query = drain(*args)
        updated.append(max(op.numRowsUpdated for op in query.recentProgress[0].stateOperators))
        return query

    rows = [(i, f"2024-01-01 0{i % 4}:{i % 60:02}:{i % 7:02}", i % 50, "view", 1.0, "{}") for i in range(2000)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(plans, "drain", noted)
    found = plans.occupancy_stream_complete(spark, str(tmp_path))
    devices_and_blocks = {(r[2], r[0] % 4, r[0] % 60 // 30) for r in rows}
    assert updated[0] <= 1.5 * len(devices_and_blocks)
    assert found.count() > 0


def test_panes_give_windows_of_any_size(spark, tmp_path):
    rows = [(f"m{i % 700}", float(i % 1900)) for i in range(5000)]
    stream = deliver(spark, [*rows, ("end", 4000.0)], f"{tmp_path}/in")
    drain(to_files(sketch_panes(stream), "q", f"{tmp_path}/cp", f"{tmp_path}/out"), spark)
    panes = spark.read.parquet(f"{tmp_path}/out")
    assert panes.count() == len({int(s // 30) for _, s in rows})
    for size, slide in ((120, 30), (600, 60), (1800, 900)):
        exact = windows(exact_occupancy(sightings(spark, rows), size, slide))
        got = windows(occupancy_from_panes(panes, size, slide))
        assert got.keys() == exact.keys()
        assert all(abs(got[s][0] - exact[s][0]) <= max(2, 0.05 * exact[s][0]) for s in exact)
    batch, stream = (windows(occupancy_from_panes(p, 600, 60)) for p in (pane_sketches(sightings(spark, rows)), panes))
    assert all(abs(batch[s][0] - stream[s][0]) <= 0.05 * batch[s][0] for s in batch)
    for size, slide in ((100, 30), (120, 40)):
        with pytest.raises(ValueError):
            occupancy_from_panes(panes, size, slide)


def test_late_rows_are_kept(spark, tmp_path):
    """Also when a batch is replayed, and for rows without a time; a stream over the rows on time drops none."""
    split = split_late(table_output(f"{tmp_path}/on_time"), table_output(f"{tmp_path}/late"), f"{tmp_path}/newest")
    deliveries = [
        [("a", 100.0), ("b", 500.0), ("old", 1.0)], [("late", 439.0), ("edge", 440.0), ("c", 460.0)], [(None, None), ("late2", 400.0)],
        [("d", 2000.0), ("late3", 0.0)], [("late4", 1939.0), ("e", 1941.0)],
    ]
    for n, rows in enumerate(deliveries):
        for _ in range(2 if n in (1, 3) else 1):
            split(sightings(spark, rows), n)
    names = lambda side: sorted(str(r["mac"]) for r in spark.read.parquet(f"{tmp_path}/{side}").collect())
    assert names("late") == ["None", "late", "late2", "late3", "late4"]
    assert names("on_time") == ["a", "b", "c", "d", "e", "edge", "old"]
    assert len(committed_batches(spark, f"{tmp_path}/newest")) == 2
    marks = {r["mac"]: r["w"] for r in spark.read.parquet(f"{tmp_path}/late").select("mac", F.unix_seconds("watermark").alias("w")).collect()}
    assert marks == {"late": 440, "late2": 440, None: 440, "late3": 440, "late4": 1940}


def test_a_stream_over_rows_on_time_drops_none(spark, tmp_path):
    split = split_late(table_output(f"{tmp_path}/on_time"), table_output(f"{tmp_path}/late"), f"{tmp_path}/newest")
    for rows in ([("a", 0.0)], [("b", 600.0)], [("late", 5.0), ("c", 545.0)], [("d", 1200.0), ("late", 530.0)]):
        stream = deliver(spark, rows, f"{tmp_path}/in")
        drain(to_batches(stream, "split", f"{tmp_path}/cp", split), spark)
        on_time = spark.readStream.schema("mac string, timestamp timestamp, batch_id int").parquet(f"{tmp_path}/on_time")
        query = drain(to_files(exact_windows(on_time), "windows", f"{tmp_path}/cp", f"{tmp_path}/out"), spark)
        assert sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators) == 0
    assert spark.read.parquet(f"{tmp_path}/on_time").count() == 4


def test_a_watch_sees_a_failure_beside_a_running_stream(spark, tmp_path):
    watch = StreamWatch(spark, f"{tmp_path}/events").start()
    try:
        for rows in ([("a", 0.0)], [("b", 900.0)], [("late", 1.0), ("c", 1800.0)]):
            stream = deliver(spark, rows, f"{tmp_path}/in")
            drain(to_files(exact_windows(stream), "sound", f"{tmp_path}/cp", f"{tmp_path}/out"), spark)
        broken = stream.select(F.raise_error(F.lit("broken on purpose")).cast("string").alias("x"))
        with pytest.raises(StreamingQueryException):
            drain(to_files(broken, "broken", f"{tmp_path}/cp", f"{tmp_path}/broken"), spark)
    finally:
        watch.stop()
    found = {(r["query"], r["event"]): r for r in watched_events(spark, f"{tmp_path}/events").collect()}
    assert {k for k in found if k[0] == "sound"} == {("sound", "started"), ("sound", "dropped"), ("sound", "stopped")}
    assert found["sound", "dropped"]["n"] > 0 and found["sound", "dropped"]["time"] is not None
    assert "broken on purpose" in found["broken", "failed"]["detail"]


@pytest.mark.parametrize(("start", "end", "rows", "lost"), [
    ({"t": {"0": 5, "1": 0}}, {"t": {"0": 9, "1": 3}}, 7, 0), ({"t": {"0": 5, "1": 0}}, {"t": {"0": 9, "1": 3}}, 4, 3),
    (None, {"t": {"0": 9}}, 2, 0), ({"t": {"0": 5}}, {"t": {"0": 6, "1": 3}}, 1, 0), ({"logOffset": 1}, {"logOffset": 2}, 5, 0),
    (3, 4, 1, 0), ({"f": [1, 2, 3]}, {"f": [2, 2, 3]}, 0, 0),
])
def test_lost_messages_from_offsets(start, end, rows, lost):
    text = lambda o: None if o is None else json.dumps(o)
    assert lost_messages({"startOffset": text(start), "endOffset": text(end), "numInputRows": rows}) == lost


@pytest.mark.parametrize("buckets", [1, 2, 64])
def test_rank_area_against_all_pairs(spark, buckets, capsys):
    draw = random.Random(4)
    rows = [(draw.choice([0.25, 0.5, draw.random()]), draw.randrange(2)) for _ in range(400)] + [(0.5, 1)] * 200
    odd = [(None, 1), (float("nan"), 0), (0.3, None)]
    df = spark.createDataFrame(rows + odd, "score double, label int").repartition(5)
    ups, downs = [s for s, x in rows if x], [s for s, x in rows if not x]
    pairs = sum((u > d) + (u == d) / 2 for u in ups for d in downs) / (len(ups) * len(downs))
    assert rank_area(df, buckets=buckets) == pytest.approx(pairs, abs=1e-12)
    assert rank_area(df.filter("label = 1")) is None and rank_area(df.limit(0)) is None
