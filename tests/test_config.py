"""Settings, connector options, folders and the command line."""

import pytest

from roompulse import workspace
from roompulse.__main__ import parser
from roompulse.config import Settings
from roompulse.session import session_conf, state_conf


def test_defaults_and_environment():
    assert Settings.from_env({}) == Settings()
    settings = Settings.from_env({"BROKER": "b:1", "TOPIC": "t", "ELASTIC": "h", "ELASTIC_PORT": "9", "INDEX": "i"})
    assert (settings.broker, settings.topic, settings.index) == ("b:1", "t", "i")
    assert settings.index_options() == {"es.nodes": "h", "es.port": "9"}


def test_message_bus_options():
    settings = Settings()
    assert settings.kafka_source_options("room") == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "room", "failOnDataLoss": "false",
    }
    assert settings.kafka_source_options("room", from_beginning=True)["startingOffsets"] == "earliest"
    catching_up = Settings(max_offsets_per_trigger=5).kafka_source_options("room")
    assert catching_up["maxOffsetsPerTrigger"] == "5"
    assert settings.kafka_sink_options("room") == {
        "kafka.bootstrap.servers": "broker:9092", "topic": "room"
    }


def test_file_formats_need_a_root():
    with pytest.raises(ValueError, match="stream_root"):
        Settings(stream_format="parquet").topic_path("room")
    with pytest.raises(ValueError, match="index_root"):
        Settings(index_format="parquet").index_path("room")


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder


class FakeSession:
    def __init__(self, conf, master, folder=None):
        self.conf, self.sparkContext = conf, FakeContext(master, folder)


def test_shared_folder_comes_from_the_session():
    assert workspace.shared_root(FakeSession({"spark.checkpoint.dir": "s3://b/c/"}, "yarn")) == "s3://b/c"
    assert workspace.shared_root(FakeSession({}, "yarn", "hdfs://n/x")) == "hdfs://n/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_root(FakeSession({}, "yarn"))
    assert "roompulse-" in workspace.shared_root(FakeSession({}, "local[2]"))


def test_folders_are_fresh(spark):
    assert workspace.new_folder(spark, "x") != workspace.new_folder(spark, "x")


def test_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session_conf(spark, {"spark.sql.shuffle.partitions": "77", "roompulse.test": "1"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "77"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("roompulse.test", None) is None
    assert "RocksDB" in state_conf(spark)["spark.sql.streaming.stateStore.providerClass"]


@pytest.mark.parametrize(
    "arguments",
    [
        ["ship-log", "l"], ["route-log", "l"], ["publish-scans", "p"], ["dump-topic", "p"],
        ["ingest-environment"], ["ingest-devices"], ["occupancy"], ["occupancy", "--form", "exact", "--window", "60"],
        ["label-log", "l", "p"],
        ["train", "c", "--save", "m"], ["score-file", "c", "m"], ["live-scores", "--model", "m"],
        ["live-scores", "--train", "c", "--strict"], ["export", "i", "p", "--first"],
    ],
)
def test_command_line(arguments):
    assert parser().parse_args(["--once", *arguments]).job == arguments[0]


def test_live_scores_need_a_model():
    with pytest.raises(SystemExit):
        parser().parse_args(["live-scores"])
