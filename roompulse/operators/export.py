"""Counts, previews and exports of stored readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows per preview and per short export.
PREVIEW_ROWS = 20
EXPORT_ROWS = 1000


def hits_total(df: DataFrame) -> DataFrame:
    """The number of documents, as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("hits"))


def preview(df: DataFrame, order: Sequence[str], n: int = PREVIEW_ROWS) -> DataFrame:
    """The first ``n`` rows in a given order; each task keeps only its own first ``n``."""
    return df.orderBy(*order).limit(n)


def first_documents(df: DataFrame, order: Sequence[str], n: int = EXPORT_ROWS) -> DataFrame:
    """The short export: the first ``n`` documents in a given order."""
    return df.orderBy(*order).limit(n)
