"""Connection settings. Formats are configuration, so one job runs on a message bus or on files."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

# Environment variable names and their defaults.
ENVIRONMENT = {
    "broker": ("BROKER", "broker:9092"),
    "topic": ("TOPIC", "room"),
    "index_host": ("ELASTIC", "elasticsearch"),
    "index_port": ("ELASTIC_PORT", "9200"),
    "index": ("INDEX", "room"),
}

# Topics and indices of the split feed.
ENV_TOPIC = "envData"
MACS_TOPIC = "macs"
ENV_INDEX = "envdata"
RAW_SUFFIX = "_raw"
# Closed windows have an index of their own, apart from the scored readings.
OCCUPANCY_SUFFIX = "_occupancy"


@dataclass(frozen=True)
class Settings:
    """Where messages come from and where results go.

    ``stream_format`` is ``kafka`` or a file format; a file format reads and writes topics as
    folders below ``stream_root``. ``index_format`` is ``es`` or a file format below ``index_root``.
    ``starting_offsets`` is where a stream without a checkpoint begins (the bus's default is the latest
    message), ``min_partitions`` the number of tasks that read a topic at least.
    ``max_offsets_per_trigger`` (messages) and ``max_bytes_per_trigger`` (files) bound a micro-batch
    when a stream has to catch up. ``follow_appended`` reads what is appended to log files, not only new files. With
    ``once_within`` (a length of time) a message that is published again within it is read once.
    """

    broker: str = ENVIRONMENT["broker"][1]
    topic: str = ENVIRONMENT["topic"][1]
    index_host: str = ENVIRONMENT["index_host"][1]
    index_port: str = ENVIRONMENT["index_port"][1]
    index: str = ENVIRONMENT["index"][1]
    stream_format: str = "kafka"
    stream_root: str | None = None
    index_format: str = "es"
    index_root: str | None = None
    fail_on_data_loss: bool = False
    starting_offsets: str | None = None
    min_partitions: int | None = None
    max_offsets_per_trigger: int | None = None
    max_bytes_per_trigger: int | None = None
    follow_appended: bool = False
    once_within: str | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> Settings:
        env = os.environ if env is None else env
        values = {field: env.get(name, default) for field, (name, default) in ENVIRONMENT.items()}
        return cls(**{**values, **overrides})

    def topic_path(self, topic: str) -> str:
        if self.stream_root is None:
            raise ValueError(f"stream_root is needed for stream_format={self.stream_format!r}")
        return f"{self.stream_root}/{topic}"

    def index_path(self, index: str) -> str:
        if self.index_root is None:
            raise ValueError(f"index_root is needed for index_format={self.index_format!r}")
        return f"{self.index_root}/{index}"

    def file_source_options(self) -> dict[str, str]:
        if self.max_bytes_per_trigger is None:
            return {}
        return {"maxBytesPerTrigger": str(self.max_bytes_per_trigger)}

    def kafka_source_options(self, topic: str, from_beginning: bool = False) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.broker,
            "subscribe": topic,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.min_partitions is not None:
            options["minPartitions"] = str(self.min_partitions)
        if from_beginning:
            options["startingOffsets"] = "earliest"
            return options
        if self.starting_offsets is not None:
            options["startingOffsets"] = self.starting_offsets
        if self.max_offsets_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        return options

    def kafka_sink_options(self, topic: str) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.broker, "topic": topic}

    def index_options(self) -> dict[str, str]:
        return {"es.nodes": self.index_host, "es.port": self.index_port}
