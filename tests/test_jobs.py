"""The submitted jobs, end to end on folders in place of a message bus and an index."""

import json

import pytest

from roompulse.config import Settings
from roompulse.plans import jobs
from roompulse.sources.index import read_index
from roompulse.sources.topics import replay_topic

ONCE = {"availableNow": True}


@pytest.fixture
def settings(tmp_path):
    return Settings(
        stream_format="parquet", stream_root=f"{tmp_path}/topics", max_bytes_per_trigger=1_000_000_000,
        index_format="parquet", index_root=f"{tmp_path}/indices",
    )


def write_log(tmp_path, count=50, **changes):
    folder = tmp_path / "logs"
    folder.mkdir()
    rows = [
        {"mac": f"m{i % 4}", "rssi": -i, "light": 5 * i, "temperature": 20.0 + i % 20, "humidity": 40.0, **changes}
        for i in range(count)
    ]
    text = "\n".join(json.dumps(r) for r in rows) + "\nnull\ngarbage\n"
    (folder / "data.log").write_text(text)
    return str(folder)


def wait(queries):
    for query in queries if isinstance(queries, list) else [queries]:
        query.awaitTermination()


def test_log_to_scores(spark, tmp_path, settings, capfd):
    logs, checkpoints = write_log(tmp_path), f"{tmp_path}/cp"
    wait(jobs.ship_log(spark, settings, logs, checkpoints, ONCE))
    messages = [json.loads(bytes(r["value"])) for r in replay_topic(spark, settings).collect()]
    assert len(messages) == 52 and all(m["timestamp"] > 1.7e9 for m in messages)

    wait(jobs.label_log(spark, settings, logs, f"{tmp_path}/training", checkpoints, ONCE))
    model, report, saved = jobs.train_model(spark, f"{tmp_path}/training", f"{tmp_path}/model")
    assert saved and report.auc > 0.5
    assert report.rejected == 0
    assert spark.read.parquet(f"{tmp_path}/training_rejected").count() == 2
    scored, confusion, rejected = jobs.score_file(spark, f"{tmp_path}/training", f"{tmp_path}/model")
    assert scored.count() == 50 and rejected.count() == 0
    assert sum(r["count"] for r in confusion.collect()) == 50

    wait(jobs.live_scores(spark, settings, model, checkpoints, trigger=ONCE))
    documents = read_index(spark, settings)
    assert documents.columns == [
        "mac", "rssi", "temperature", "humidity", "light", "prediction", "prediction_str", "timestamp",
    ]
    assert documents.count() == 50
    assert read_index(spark, settings, "room_rejected").count() == 2
    assert "batch 0" in capfd.readouterr().out


def test_route_and_ingest(spark, tmp_path, settings):
    logs, checkpoints = write_log(tmp_path), f"{tmp_path}/cp"
    wait(jobs.route_log(spark, settings, logs, checkpoints, ONCE))
    wait(jobs.ingest_environment(spark, settings, checkpoints, console=False, trigger=ONCE))
    devices = Settings(**{**settings.__dict__, "topic": "macs", "index": "macs"})
    wait(jobs.ingest_devices(spark, devices, checkpoints, console=False, trigger=ONCE))

    environment = read_index(spark, settings, "envdata")
    assert environment.columns == ["light", "temperature", "humidity", "timestamp"]
    raw = read_index(spark, settings, "macs_raw")
    assert raw.columns == ["mac", "rssi", "timestamp"]
    assert environment.count() == raw.count() == 52
    assert dict(raw.dtypes)["timestamp"] == "string"

    assert jobs.export_index(spark, settings, "macs_raw", f"{tmp_path}/csv") == 52
    exported = spark.read.option("header", True).csv(f"{tmp_path}/csv")
    assert exported.columns == ["mac", "rssi", "timestamp"] and exported.count() == 52


def test_index_documents_are_keyed_by_message(spark, monkeypatch):
    from roompulse.streaming import outputs

    written = []
    monkeypatch.setattr(outputs, "write_index", lambda df, *rest: written.append((df.columns, rest[1:])))
    write = outputs.index_output(Settings(), "room")
    write(spark.createDataFrame([("room-0-1", 2.0)], "document_id string, light double"), 0)
    write(spark.createDataFrame([(2.0,)], "light double"), 1)
    assert written == [
        (["document_id", "light"], ("room", "document_id")), (["light"], ("room", None)),
    ]


@pytest.mark.parametrize("form", ["approx", "sketched", "exact"])
def test_occupancy_job(spark, tmp_path, settings, form):
    from pyspark.sql import functions as F

    rows = spark.range(200).select(
        F.concat(F.lit("m"), F.col("id") % 9).alias("mac"), F.lit(-5).alias("rssi"),
        (F.col("id") * 10.0).alias("timestamp"),
    )
    jobs.write_topic(rows, settings)
    queries = jobs.occupancy(
        spark, settings, f"{tmp_path}/cp", console=form == "approx", trigger=ONCE, form=form,
        window_seconds=60, slide_seconds=20, devices_per_person=2,
    )
    wait(queries)
    windows = read_index(spark, settings, "room_occupancy")
    assert windows.columns == ["start", "end", "distinct_macs", "approx_people"]
    # Six readings of six devices in each whole window.
    middle = windows.filter("start >= timestamp'1970-01-01 00:05:00'")
    assert middle.filter("distinct_macs <> 6 OR approx_people <> 3").count() == 0 and middle.count() > 50
    assert windows.filter("unix_seconds(end) - unix_seconds(start) <> 60").count() == 0
    assert windows.agg(F.max("end")).first()[0].timestamp() <= 1990 - 60
    if form == "approx":
        assert "Console" in queries[1].lastProgress.sink.description


def test_scans_and_topic_dump(spark, tmp_path, settings):
    (tmp_path / "macs.csv").write_text("00:00,-20\nbad\n10:21,-50\n")
    jobs.publish_scans(spark, settings, str(tmp_path / "macs.csv"))
    macs = Settings(**{**settings.__dict__, "topic": "macs"})
    jobs.dump_topic(spark, macs, f"{tmp_path}/dump")
    values = {r["message"] for r in spark.read.json(f"{tmp_path}/dump").collect()}
    assert values == {'{"mac_address":"00:00","rssi":"-20"}', '{"mac_address":"10:21","rssi":"-50"}'}


def test_short_export(spark, tmp_path, settings):
    jobs_rows = spark.range(1500).withColumnRenamed("id", "mac")
    jobs_rows.write.parquet(settings.index_path("big"))
    assert jobs.export_index(spark, settings, "big", f"{tmp_path}/csv", first=True) == 1500
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 1000


def test_shipping_keeps_undeclared_keys_types_and_bad_lines(spark, tmp_path, settings):
    folder = tmp_path / "logs"
    folder.mkdir()
    lines = ['{"mac":"m","rssi":-1,"co2":400,"light":"7","n":{"a":[1,null]}}', "garbage", '{"timestamp":3}']
    (folder / "a.log").write_text("\n".join(lines) + "\n")
    wait(jobs.ship_log(spark, settings, str(folder), f"{tmp_path}/cp", ONCE))
    messages = [json.loads(bytes(r["value"])) for r in replay_topic(spark, settings).collect()]
    assert all(m.pop("timestamp") > 1.7e9 for m in messages)
    assert sorted(messages, key=str) == sorted(
        [{"mac": "m", "rssi": -1, "co2": 400, "light": "7", "n": {"a": [1, None]}}, {"log": "garbage"}, {}], key=str)
    wait(jobs.route_log(spark, settings, str(folder), f"{tmp_path}/cp", ONCE))
    routed = {topic: [json.loads(bytes(r["value"])) for r in replay_topic(spark, settings, topic).collect()]
              for topic in ("envData", "macs")}
    assert any(m.get("co2") == 400 and "mac" not in m and m["light"] == "7" for m in routed["envData"])
    assert any(m.get("co2") == 400 and m["mac"] == "m" and "light" not in m for m in routed["macs"])


def test_training_and_scoring_count_what_they_reject(spark, tmp_path, settings):
    good = [f"{h},{t},{lux},{int(h < 60)}" for h, t, lux in ((30 + i % 60, 20 + i % 7, 10.0 * i) for i in range(200))]
    odd = [",21,5,1", "40,x,5,1", "40,21,5,", "40,21,5,2"]
    decimal = ["40.0,21,5,1.0"]
    path = tmp_path / "training.csv"
    path.write_text("\n".join(["humidity,temperature,light,comfortable", *good, *odd, *decimal]) + "\n")
    model, report, saved = jobs.train_model(spark, str(path), f"{tmp_path}/model", f"{tmp_path}/rejects")
    assert saved and report.rejected == 4 and report.auc > 0.95
    rejects = spark.read.option("header", True).csv(f"{tmp_path}/rejects")
    assert {r["line"] for r in rejects.collect()} == set(odd)
    scored, _, rejected = jobs.score_file(spark, str(path), f"{tmp_path}/model")
    # Without a label a row is still scored; kept and rejected are the input.
    assert (scored.count(), rejected.count()) == (203, 2)
    assert scored.filter("humidity = 40 and comfortable = 1 and light = 5").count() == 1


def test_scores_and_occupancy_share_settings(spark, tmp_path, settings):
    logs, checkpoints = write_log(tmp_path), f"{tmp_path}/cp"
    wait(jobs.ship_log(spark, settings, logs, checkpoints, ONCE))
    from roompulse.plans.batch import FIXED_MODEL as model

    wait(jobs.live_scores(spark, settings, model, checkpoints, console=False, trigger=ONCE))
    wait(jobs.occupancy(spark, settings, checkpoints, trigger=ONCE))
    assert read_index(spark, settings).count() == 50
    assert "prediction" in read_index(spark, settings).columns
    assert "distinct_macs" in read_index(spark, settings, "room_occupancy").columns


def test_export_of_several_indices(spark, tmp_path, settings):
    for name, rows in (("a", 3), ("b", 4)):
        spark.range(rows).write.parquet(settings.index_path(name))
    assert jobs.export_indices(spark, settings, ["a", "b"], f"{tmp_path}/csv") == {"a": 3, "b": 4}
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv/b").count() == 4


def test_scan_lines_become_readings(spark, tmp_path):
    (tmp_path / "macs.csv").write_text("aa,-5\nbb, -70 ,more\ncc\ndd,strong\n\n")
    jobs.convert_scans(spark, str(tmp_path / "macs.csv"), f"{tmp_path}/logs")
    found = spark.read.schema("mac string, rssi int").json(f"{tmp_path}/logs")
    assert sorted(map(tuple, found.collect())) == [("aa", -5), ("bb", -70)]
    rejected = spark.read.text(f"{tmp_path}/logs_rejected")
    assert sorted(r["value"] for r in rejected.collect()) == ["", "cc", "dd,strong"]


def test_json_and_container_logs_are_parsed_in_one_pass(spark, tmp_path):
    (tmp_path / "in.log").write_text('{"a":"x","k":3}\nnot json\n{"k":"text"}\n[1]\n{"a":\n')
    jobs.parse_logs(spark, str(tmp_path / "in.log"), "json", f"{tmp_path}/out", ["a", "k int"])
    schema = "value string, fields struct<a: string, k: int>, matched boolean"
    rows = sorted((r["matched"], r["value"] or "", r["fields"] and tuple(r["fields"])) for r in spark.read.schema(schema).json(f"{tmp_path}/out").collect())
    assert [r[1] for r in rows if not r[0]] == ["[1]", "not json", '{"a":', '{"k":"text"}']
    assert [r[2] for r in rows if r[0]] == [("x", 3)]
    with pytest.raises(ValueError):
        jobs.parse_logs(spark, str(tmp_path / "in.log"), "json", f"{tmp_path}/other")


def test_lines_with_other_numbers_of_fields_are_kept_whole(spark, tmp_path):
    from roompulse.schemas import TRAINING_ROW
    from roompulse.sources.files import read_appended_csv

    (tmp_path / "rows.csv").write_text("light,temperature,humidity,comfortable\n1,2,3,1\n1,2,3,1,more,fields\n4,5\n6,x,7,0\n")
    rows = read_appended_csv(spark, str(tmp_path / "rows.csv"), TRAINING_ROW, text="line").collect()
    found = sorted((r["line"], r["light"], r["temperature"], r["comfortable"]) for r in rows)
    assert found == [("1,2,3,1", 1.0, 2.0, 1), ("1,2,3,1,more,fields", 1.0, 2.0, 1), ("4,5", 4.0, 5.0, None), ("6,x,7,0", 6.0, None, 0)]
