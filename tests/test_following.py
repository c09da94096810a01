"""Following files that grow, messages read once, and records stamped whole."""

import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from roompulse.functions.ingest import message_key, stamped_records
from roompulse.sinks.stream import drain, to_files
from roompulse.sources import tail
from roompulse.sources.topics import once_only


def append(path, data):
    with open(path, "ab") as file:
        file.write(data)


@pytest.fixture
def follow(spark, tmp_path):
    """Drains what is new; returns all rows so far."""
    os.mkdir(tmp_path / "logs")

    def run(pattern="", **options):
        stream = tail.tail_lines(spark, f"{tmp_path}/logs{pattern}", **options)
        drain(to_files(stream, "follow", f"{tmp_path}/cp", f"{tmp_path}/out"), spark)
        return sorted((r["value"], r["position"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    return run


def test_appended_bytes_are_read_on(follow, tmp_path):
    log = tmp_path / "logs" / "a.log"
    append(log, b"one\ntwo\nthr")
    assert follow() == [("one", 0), ("two", 4)]
    assert follow() == [("one", 0), ("two", 4)]
    append(log, b"ee\r\n\n\xff\n")
    assert follow() == [("", 15), ("one", 0), ("three", 8), ("two", 4), ("�", 16)]


def test_a_rotated_log_is_read_to_its_end(follow, tmp_path):
    logs = tmp_path / "logs"
    append(logs / "room.log", b"a\n")
    append(logs / "other.txt", b"no\n")
    assert follow("/room.log*") == [("a", 0)]
    append(logs / "room.log", b"b\n")
    os.rename(logs / "room.log", logs / "room.log.1")
    append(logs / "room.log", b"c\n")
    assert follow("/room.log*") == [("a", 0), ("b", 2), ("c", 0)]
    os.remove(logs / "room.log.1")
    append(logs / "room.log", b"d\n")
    assert follow("/room.log*") == [("a", 0), ("b", 2), ("c", 0), ("d", 2)]


def test_a_log_begun_anew_is_read_from_its_start(follow, tmp_path):
    log = tmp_path / "logs" / "a.log"
    append(log, b"first\nsecond\n")
    follow()
    log.write_bytes(b"longer than what was there before\n")
    assert follow() == [("first", 0), ("longer than what was there before", 0), ("second", 6)]
    log.write_bytes(b"short\n")
    assert ("short", 0) in follow()


@pytest.mark.parametrize("task, block", [(1, 1), (5, 3), (64, 7), (1 << 20, 1 << 20)])
def test_every_line_is_in_one_range(follow, tmp_path, monkeypatch, task, block):
    """Ranges and blocks smaller and larger than lines, read without a stream."""
    monkeypatch.setattr(tail, "TASK_BYTES", task)
    monkeypatch.setattr(tail, "BLOCK_BYTES", block)
    lines = [b"", b"x", b"word " * 9, b"", b"yy"] * 7
    append(tmp_path / "logs" / "a.log", b"".join(line + b"\n" for line in lines) + b"held back")
    reader = tail.TailReader({"path": f"{tmp_path}/logs"})
    parts = reader.partitions({}, reader.latestOffset())
    rows = [r for part in parts for batch in reader.read(part) for r in batch.to_pylist()]
    assert [r["value"].encode() for r in rows] == lines
    assert [r["position"] for r in rows] == [sum(len(x) + 1 for x in lines[:i]) for i in range(len(lines))]


def test_a_file_that_is_gone(tmp_path):
    os.mkdir(tmp_path / "logs")
    append(tmp_path / "logs" / "a.log", b"x\n")
    reader = tail.TailReader({"path": f"{tmp_path}/logs"})
    end = reader.latestOffset()
    os.remove(tmp_path / "logs" / "a.log")
    with pytest.raises(FileNotFoundError):
        reader.partitions({}, end)
    assert tail.TailReader({"path": f"{tmp_path}/logs", "failOnDataLoss": "false"}).partitions({}, end) == []
    assert tail.TailReader({"path": f"{tmp_path}/nowhere/x*"}).latestOffset() == {}


def test_a_stream_can_begin_at_the_end(follow, tmp_path):
    append(tmp_path / "logs" / "a.log", b"old\n")
    assert follow(startingOffsets="latest") == []
    append(tmp_path / "logs" / "a.log", b"new\n")
    assert follow(startingOffsets="latest") == [("new", 4)]


MESSAGE = "key binary, value string, topic string, partition int, offset long, timestamp timestamp"


def test_messages_that_come_again_are_read_once(spark, tmp_path):
    deliveries = [
        [("a", "1", "t", 0, 0, 0), ("b", "2", "t", 0, 1, 0), (None, "same", "t", 0, 2, 1), (None, "same", "t", 0, 3, 1)],
        [("a", "1", "t", 0, 4, 60), (None, "same", "t", 0, 2, 60), (None, "bare", None, None, None, None), (None, "bare", None, None, None, None)],
        [("b", "2", "t", 0, 5, 120), ("c", "3", "t", 0, 6, 7200)],
        [("c", "3", "t", 0, 7, 7300), ("a", "1", "t", 0, 8, 99_999)],
    ]
    for rows in deliveries:
        rows = [(k and k.encode(), *rest) for k, *rest in rows]
        df = spark.createDataFrame(
            [(*r[:5], None if r[5] is None else float(r[5])) for r in rows], "key binary, value string, topic string, partition int, offset long, s double")
        df.withColumn("timestamp", F.col("s").cast("timestamp")).drop("s").write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(MESSAGE).parquet(f"{tmp_path}/in")
        drain(to_files(once_only(stream, "1 hour"), "once", f"{tmp_path}/cp", f"{tmp_path}/out"), spark)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.columns == [c.split()[0] for c in MESSAGE.split(", ")]
    got = sorted(r["value"] for r in out.collect())
    # Event times don't matter, however late; messages without key and place are taken as they are.
    assert got == ["1", "2", "3", "bare", "bare", "same", "same"]


def stamped(spark, rows, **options):
    out = stamped_records(spark.createDataFrame([(r,) for r in rows], "value string"), **options).collect()
    return [json.loads(r["value"]) for r in out], [r["value"] for r in out]


@pytest.mark.parametrize("line", [
    '{"a":1,"a":2}', '{"a":1} tail', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1},"e":0}', '[1]', "1", "null", "", " ", '{"a":', '{"a":{"x":1,"x":2}}',
    '{"a":1},"' + "0" * 32 + '":0} x', "{'a':1}", '{"a":NaN}',
])
def test_lines_that_are_no_object_go_whole(spark, line):
    (record,), _ = stamped(spark, [line])
    assert record.pop("timestamp") > 1.7e9 and record == {"log": line}


@pytest.mark.parametrize("line", [
    '{"a":1e400}', '{"a":1.10,"b":[ 1, {"c":null} ]}', '  {"a":"}"}  ', "{}", ' { } ', '{"a":' + "1" * 50 + "}", '{"timestamp2":1}', '{"":1}',
    '{"é":"\\ud83d\\ude00 \\"x\\""}',
])
def test_objects_keep_their_text(spark, line):
    (record,), (text,) = stamped(spark, [line])
    body = line.strip()[:-1].rstrip()
    assert text.startswith(body) and record.pop("timestamp") > 1.7e9 and record == json.loads(line)


def test_keys_that_go(spark):
    lines = ['{"mac":"m","light":2.50,"timestamp":3}', '{"light":1}', '{"mac":1,"x":1e400}', '{"mac":"Infinity","x":"Infinity"}',
             '{"mac":' + "1" * 50 + ',"x":1}', '{"mac":1,"x":' + "9" * 40 + "}"]
    records, _ = stamped(spark, lines, without=("mac",))
    assert all(r.pop("timestamp") > 1.7e9 for r in records)
    assert records == [{"light": 2.5}, {"light": 1}, {"log": lines[2]}, {"x": "Infinity"}, {"log": lines[4]}, {"log": lines[5]}]


def test_message_keys_tell_lines_apart(spark):
    rows = [("x", "f", 0), ("x", "f", 2), ("x", "g", 0), ("y", "f", 0), (None, "f", 0)]
    df = spark.createDataFrame(rows, "value string, source string, position long").select(message_key().alias("key"), "value")
    out = stamped_records(df)
    assert out.columns == ["key", "value"] and len({bytes(r["key"]) for r in out.collect()}) == 5
