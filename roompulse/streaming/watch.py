"""Watching streams: failures, dropped rows and lost messages of all queries of a session, kept as a table."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

EVENTS = "time timestamp, query string, run_id string, event string, batch_id long, n long, detail string"


def lost_messages(source: dict) -> int:
    """Messages between a batch's offsets that weren't read: those that a topic had deleted, or markers of transactions."""
    try:
        start, end = json.loads(source["startOffset"] or "null"), json.loads(source["endOffset"])
        due = sum(
            last - start[topic][partition] for topic, partitions in end.items() for partition, last in partitions.items()
            if partition in (start or {}).get(topic, {}))
    except (TypeError, ValueError, AttributeError, KeyError):  # offsets of another kind of source
        return 0
    known = all(p in (start or {}).get(t, {}) for t, ps in end.items() for p in ps)
    return max(0, due - source["numInputRows"]) if known else 0


class StreamWatch(StreamingQueryListener):
    """Writes one small JSON file per noteworthy event of any stream: started, dropped, lost, failed, stopped.

    Batches in which nothing was dropped or lost write nothing. The listener runs on the driver, beside the streams, and
    goes on when one of them fails.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.names = spark, path, {}

    def start(self) -> StreamWatch:
        self.spark.streams.addListener(self)
        return self

    def stop(self) -> None:
        """Wait for the events so far, then stop watching."""
        self.spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)

    def _write(self, run: str, event: str, batch: int | None = None, n: int | None = None, detail: str | None = None) -> None:
        row = {"time": datetime.now(timezone.utc).isoformat(), "query": self.names.get(run), "run_id": run, "event": event,
               "batch_id": batch, "n": n, "detail": detail}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{event}-{uuid.uuid4().hex}.json")
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(json.dumps(row).encode() + b"\n"))
        out.close()

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name
        self._write(str(event.runId), "started")

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        run, batch = progress["runId"], progress["batchId"]
        dropped = sum(op.get("numRowsDroppedByWatermark", 0) for op in progress.get("stateOperators", []))
        if dropped:
            self._write(run, "dropped", batch, dropped)
        for source in progress.get("sources", []):
            lost = lost_messages(source)
            if lost:
                self._write(run, "lost", batch, lost, source.get("description"))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        self._write(run, "failed" if event.exception else "stopped", detail=event.exception)
        self.names.pop(run, None)


def watched_events(spark: SparkSession, path: str) -> DataFrame:
    """The table of what happened."""
    return spark.read.schema(EVENTS).json(path)
