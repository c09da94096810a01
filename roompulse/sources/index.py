"""Search-index scan, partitioned by the connector or by part files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roompulse.config import Settings


OWN_BATCH_ID = "_batch_id"


def read_index(spark: SparkSession, settings: Settings, index: str | None = None) -> DataFrame:
    """All documents of an index as columns."""
    index = index or settings.index
    reader = spark.read.format(settings.index_format)
    if settings.index_format == "es":
        return reader.options(**settings.index_options()).load(index)
    documents = reader.load(settings.index_path(index))
    # A callback's sink keeps one folder per batch, which shows up as the last column; a document's own column
    # of that name is written under another one.
    documents = documents.drop("batch_id")
    return documents.withColumnRenamed(OWN_BATCH_ID, "batch_id")
