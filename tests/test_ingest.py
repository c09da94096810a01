"""Good, odd and broken messages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roompulse.functions.ingest import (
    iso_text, parse_messages, parse_readings, scan_line, timestamp_text, to_json_value,
    with_document_id, with_ingest_time,
)
from roompulse.schemas import DEVICE_SIGHTING, ENVIRONMENT_READING, ROOM_READING, TRAINING_ROW
from roompulse.sources.files import read_appended_csv, read_csv, two_field_rows

GOOD = '{"mac":"aa:bb","rssi":-50,"light":12,"temperature":21.5,"humidity":40.0,"timestamp":1717000000.25}'


def parse_one(spark, text, schema=ROOM_READING):
    messages = spark.createDataFrame([(text,)], "value string").select(F.col("value").cast("binary"))
    return parse_messages(messages, schema).first().asDict()


def test_good_message(spark):
    assert parse_one(spark, GOOD) == {
        "mac": "aa:bb", "rssi": -50, "temperature": 21.5, "humidity": 40.0, "light": 12.0,
        "timestamp": 1717000000.25,
    }


@pytest.mark.parametrize("text", ["garbage", "null", "", "{}", '{"light":nan}', None])
def test_unusable_message_is_all_null(spark, text):
    assert set(parse_one(spark, text).values()) == {None}


@pytest.mark.parametrize(
    ("text", "nulls"),
    [
        (GOOD.replace('"mac":"aa:bb",', ""), {"mac"}),
        (GOOD.replace("{", '{"extra":[1],'), set()),
        (GOOD.replace("-50", "-5.5"), {"rssi"}),
        (GOOD.replace("-50", '"-50"'), {"rssi"}),
        (GOOD.replace("12", '"7"'), {"light"}),
    ],
)
def test_a_bad_key_nulls_only_itself(spark, text, nulls):
    assert {name for name, value in parse_one(spark, text).items() if value is None} == nulls


def test_empty_and_numeric_mac(spark):
    assert parse_one(spark, GOOD.replace("aa:bb", ""))["mac"] == ""
    assert parse_one(spark, GOOD.replace('"aa:bb"', "17"))["mac"] == "17"


def test_misshaped_sighting_is_all_null(spark):
    text = '{"mac_address":"10:21:50:03:40:10","rssi":"-50"}'
    assert set(parse_one(spark, text, DEVICE_SIGHTING).values()) == {None}


def test_schemas(spark):
    messages = spark.createDataFrame([(GOOD,)], "value string")
    for schema in (ROOM_READING, DEVICE_SIGHTING, ENVIRONMENT_READING):
        assert parse_messages(messages, schema).schema == schema
    assert dict(parse_readings(messages, ROOM_READING).dtypes)["timestamp"] == "timestamp"


def test_document_id_is_the_messages_place(spark):
    envelope = spark.createDataFrame(
        [(GOOD, "room", 3, 41)], "value string, topic string, partition int, offset long"
    )
    row = parse_readings(with_document_id(envelope), ROOM_READING).first()
    assert (row["document_id"], row["mac"]) == ("room-3-41", "aa:bb")


def test_time_texts(spark):
    messages = spark.createDataFrame([(GOOD,)], "value string")
    row = parse_readings(messages, ROOM_READING).select(
        iso_text("timestamp").alias("iso"), timestamp_text("timestamp").alias("text")
    ).first()
    assert row["iso"] == "2024-05-29T16:26:40.250+0000"
    assert row["text"] == "2024-05-29 16:26:40.25"


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("10:21:50:03:40:10,-50", ("10:21:50:03:40:10", -50)),
        ("a, -5 ", ("a", -5)),
        ("a,-20,z", ("a", -20)),
        (",-7", ("", -7)),
        ("a", None), ("a,x", None), ("a,", None), ("", None), ("a,1.5", None), (None, None),
    ],
)
def test_scan_line(spark, line, expected):
    df = spark.createDataFrame([(line,)], "value string")
    parsed = df.select(scan_line("value").alias("r")).first()["r"]
    assert (None if parsed is None else tuple(parsed)) == expected


def test_two_field_rows(spark):
    lines = ["00:00,-20", "a", "a,b,c", "", '"x,y",-1', "a,", ",b", "a,b,", "p, q "]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    rows = [tuple(r) for r in two_field_rows(df, "mac_address", "rssi").collect()]
    assert sorted(rows) == sorted([("00:00", "-20"), ("x,y", "-1"), ("a", ""), ("", "b"), ("p", " q ")])


def test_json_value_keeps_nulls(spark):
    df = spark.createDataFrame([("m", None)], "mac string, rssi int")
    assert to_json_value(df).first()["value"] == '{"mac":"m","rssi":null}'


def test_ingest_time(spark):
    stamped = with_ingest_time(spark.range(5)).select("timestamp").distinct().collect()
    assert len(stamped) == 1
    assert abs(stamped[0][0] - dt.datetime.now(dt.UTC).timestamp()) < 300


def test_appended_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "light,temperature,humidity,comfortable\n2.5,49.7,85.8,0\n"
        "light,temperature,humidity,comfortable\n30,20,50,1\nx,20,50,1\n"
    )
    df = read_appended_csv(spark, str(tmp_path), TRAINING_ROW)
    assert df.schema == TRAINING_ROW
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [(2.5, 49.7, 85.8, 0), (30.0, 20.0, 50.0, 1), (None, 20.0, 50.0, 1)], key=str
    )
    assert df.count() == 3


def test_csv_types_are_inferred(spark, tmp_path):
    (tmp_path / "t.csv").write_text("light,temperature,humidity,comfortable\n2.5,49.7,85.8,0\n")
    assert read_csv(spark, str(tmp_path)).schema == TRAINING_ROW
