"""Literal rows and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def literal_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A small table written in code."""
    return spark.createDataFrame(list(rows), list(names))


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
