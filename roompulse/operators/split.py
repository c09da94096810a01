"""Train/test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The train share and the seed.
TRAIN_SHARE = 0.7
SEED = 42


def random_split(df: DataFrame, share: float = TRAIN_SHARE, seed: int = SEED) -> list[DataFrame]:
    """Spark's random split; it depends on the input's partitions and order."""
    return df.randomSplit([share, 1.0 - share], seed=seed)


def in_train(key: str, tenths: int = 7) -> Column:
    """Whether a row trains, from a hash of its key: the same under any partitioning or retry."""
    digest = F.md5(F.col(key).cast("string"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10
    return bucket < tenths


def hash_split(df: DataFrame, key: str, tenths: int = 7) -> tuple[DataFrame, DataFrame]:
    return df.filter(in_train(key, tenths)), df.filter(~in_train(key, tenths))
