"""The query catalogue: each query with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roompulse.session import session_conf

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The reading columns that the SQL side derives from the events table.
READINGS_SQL = """
WITH readings AS (
  SELECT event_id, ts, event_type, user_id,
         'm' || user_id AS mac,
         CAST(-CAST(props::JSON->>'k' AS INTEGER) AS INTEGER) AS rssi,
         CAST(10 + event_id % 30 AS DOUBLE) AS temperature,
         CAST(30 + event_id % 53 AS DOUBLE) AS humidity,
         value * 8 AS light,
         CAST(epoch_us(ts) AS DOUBLE) / 1e6 AS epoch,
         make_timestamp(CAST(trunc((CAST(epoch_us(ts) AS DOUBLE) / 1e6) * 1e6) AS BIGINT)) AS parsed_ts
  FROM events
)
"""


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under its function's name; text results are in UTC."""

    def register(function: Query) -> Query:
        key = name or function.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with session_conf(spark, {"spark.sql.session.timeZone": "UTC"}):
                return function(spark, sf_dir)

        run.__name__ = function.__name__
        run.__doc__ = function.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register
